import threading
from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakemart.operators import gates, security
from lakemart.plans import marts
from lakemart.plans.pipeline import COMMENTS, Config, publish_gold, run_pipeline
from lakemart.plans.samples import SampleBronze
from lakemart.streaming import ingest

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.pipeline


@pytest.fixture(scope="module")
def bronze(spark):
    return SampleBronze(spark, SMALL)


def config(tmp, run, **more):
    return Config(str(tmp), run, allowed_gold_violations=10**9, **more)


def test_two_runs(spark, bronze, tmp_path):
    drops = ingest.CsvDrops(str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "state"))
    bronze.transactions().write.csv(drops.source, header=True, nullValue="null")
    spark.sql("CREATE DATABASE IF NOT EXISTS pipeline_gold")
    everybody = security.Policy(spark.createDataFrame([], "principal string, member_of string"), privileged=(security.current_principal(spark),))
    first = run_pipeline(
        bronze, config(tmp_path, "r1", drops=drops, pages=f"{SMALL}/pages.parquet", schema="pipeline_gold", policy=everybody)
    )
    counts = {r.dataset: r for r in first.reconciliation.collect()}
    assert len(counts) == 5
    for r in counts.values():
        assert r.total == r.valid + r.quarantined > 0 and r.quarantined > 0
    report = {r.check_name: r.violations for r in first.gold_report.collect()}
    assert len(report) == 11 and report["fact_sales.transaction_id_unique"] == 0
    assert first.star.fact_sales.count() == counts["transactions"].valid
    assert spark.table("pipeline_gold.fact_sales").count() == first.star.fact_sales.count()
    assert first.index.count() == first.chunks.count() == first.chunks.select("chunk_id").distinct().count()

    # Unreadable quantities went to quarantine, with a reason.
    bad = spark.read.parquet(f"{tmp_path}/r1/judged/transactions").filter("verdict = 'quarantine'")
    assert bad.filter(F.exists("_errors", lambda e: e["name"] == "readable_values")).count() > 0

    # Running again without new files gives the same tables, and embeds nothing new.
    second = run_pipeline(
        bronze, config(tmp_path, "r2", drops=drops, pages=f"{SMALL}/pages.parquet", previous_run="r1")
    )
    key = lambda df: sorted(map(str, df.collect()))
    assert key(second.star.fact_sales) == key(first.star.fact_sales)
    assert key(second.index) == key(first.index)
    for table in ("fact_sales", "dim_customer", "dim_product", "dim_date"):
        spark.sql(f"DROP VIEW pipeline_gold.{table}")
    spark.sql("DROP DATABASE pipeline_gold")


def test_policy_comes_before_gold(spark, bronze, tmp_path):
    members = spark.createDataFrame([("ann", "admins")], "principal string, member_of string")
    policy = security.Policy(members, open_region="NATION_3")
    result = run_pipeline(bronze, config(tmp_path, "r", policy=policy))
    everything = marts.top_customers(result.star_for("ann")).collect()
    assert everything == marts.top_customers(result.star).collect()
    shown = result.star_for("bob").dim_customer
    assert {r.billing_state for r in shown.collect()} == {"NATION_3"}
    allowed = {r.customer_id for r in shown.collect()}
    assert {r.customer_id for r in marts.top_customers(result.star_for("bob")).collect()} <= allowed

    unreadable = security.Policy(spark.createDataFrame([("ann",)], "principal string"))
    with pytest.raises(PySparkException):
        run_pipeline(bronze, config(tmp_path, "bad", policy=unreadable))
    assert not (tmp_path / "bad" / "gold").exists()


def test_published_customers_follow_the_reader(spark, bronze, tmp_path):
    spark.sql(f"CREATE DATABASE governed LOCATION '{tmp_path}/catalog'")
    nobody = security.Policy(spark.createDataFrame([("ann", "admins")], "principal string, member_of string"), open_region="NATION_3")
    first = run_pipeline(bronze, config(tmp_path, "r1", schema="governed", policy=nobody))
    plain = spark.table("governed.dim_customer").collect()
    secure = security.secure_view(first.star.dim_customer, nobody).collect()
    assert sorted(map(str, plain)) == sorted(map(str, secure)) and {r.phone for r in plain} == {security.MASK}
    assert spark.table("governed.fact_sales").count() == first.star.fact_sales.count()

    # While names move to another run and policy, each is there all the time.
    me = spark.createDataFrame([(security.current_principal(spark), "admins")], "principal string, member_of string")
    other = replace(first.cfg, run="r1b", policy=replace(nobody, memberships=me))
    missing, done = [], threading.Event()

    def watch():
        while not done.is_set():
            missing.extend(n for n in COMMENTS if not spark.catalog.tableExists(f"governed.{n}"))

    watcher = threading.Thread(target=watch)
    watcher.start()
    for _ in range(5):
        publish_gold(spark, other, first.paths)
    done.set()
    watcher.join()
    assert missing == []
    assert spark.table("governed.dim_customer").count() == first.star.dim_customer.count() > len(plain)
    assert spark.sql("SELECT count(phone) AS n FROM governed.dim_customer WHERE phone = '********'").head().n == 0
    spark.sql("DROP DATABASE governed CASCADE")


def test_no_publishing_without_a_policy(bronze, tmp_path):
    with pytest.raises(ValueError, match="policy"):
        run_pipeline(bronze, config(tmp_path, "r", schema="anywhere"))
    assert not (tmp_path / "r").exists()


def test_gold_gate_stops_the_run(bronze, tmp_path):
    with pytest.raises(gates.GateFailed, match="gold checks failed"):
        run_pipeline(bronze, Config(str(tmp_path), "r"))
