"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakemart.plans.registry import build_queries  # noqa: E402
from lakemart.session import build_session  # noqa: E402

HEADLINE = (
    "monthly_sales", "top_customers", "sales_by_category", "product_rank",
    "fact_sales", "dedup_transactions", "quarantine_transactions", "scd2_account",
    "gold_quality", "document_chunks", "page_text", "bm25_topk", "vector_topk", "hybrid_topk",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        **{"spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    queries = build_queries()
    spark.read.parquet(f"{folder}/nation.parquet").count()  # start the JVM's pools
    times = {}
    for name in wanted:
        best = None
        for _ in range(2):  # cold and warm; the warm one counts
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
