"""Run registered queries and their oracle SQL side by side.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def engine(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return [_cell(x) for x in v]
    return str(v)


def normal(columns: list[str], rows: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(str(_cell(r[i])) for i in order) for r in rows))


def compare(spark, con, name: str, folder: str, query, sql: str) -> str:
    """Empty text if both engines agree, else what differs."""
    df = query(spark, folder)
    got = df.collect()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(set(df.columns) ^ set(columns))}"
    a, b = normal(df.columns, got), normal(columns, want)
    if a == b:
        return ""
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"rows {len(a)} vs {len(b)}\n   spark {only_a}\n   sql   {only_b}"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from lakemart.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]", shuffle_partitions=8, **{"spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = engine(folder)
    oracle = oracle_sql()
    bad = 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracle:
                note = compare(spark, con, name, folder, query, oracle[name])
            else:
                note = ""
                print(f"     {name}: {query(spark, folder).count()} rows, no oracle")
        except Exception as problem:  # report and go on
            note = f"{type(problem).__name__}: {str(problem)[:700]}"
        bad += bool(note)
        print(f"{'FAIL' if note else 'ok  '} {name} {time.time() - start:.1f}s {note}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
