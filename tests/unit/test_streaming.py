import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakemart.operators import cdc, quality, silver
from lakemart.streaming import ingest
from lakemart.streaming import silver as streams

HEADER = (
    "transaction_id,opportunity_name,product_id,store_id,quantity,selling_price,"
    "discount_amount,transaction_timestamp,payment_mode,sales_channel"
)


def line(tid, quantity="2", more=""):
    return f'{tid},"Deal, big",p1,s1,{quantity},10.00,null,05-Jan-2025 01.00.00 PM,Cash,Store{more}'


@pytest.fixture
def drops(tmp_path):
    (tmp_path / "in").mkdir()
    return ingest.CsvDrops(str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "state"))


def put(drops, name, *lines):
    with open(os.path.join(drops.source, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_evolving_headers(spark, drops):
    put(drops, "a.csv", HEADER, line("t1"), line("t2", quantity="many"))
    ingest.run(spark, drops)
    assert ingest.read_table(spark, drops).columns == [*HEADER.split(","), ingest.RESCUED]

    put(drops, "b.csv", HEADER + ",tier", line("t3", more=",gold"))
    moved = HEADER.split(",")[::-1]
    put(drops, "c.csv", ",".join(moved), ",".join(line("t4").replace('"Deal, big"', "x").split(",")[::-1]))
    put(drops, "empty.csv")
    put(drops, "notes.txt", "not a delivery")
    ingest.run(spark, drops)
    ingest.run(spark, drops)  # nothing new

    table = ingest.read_table(spark, drops)
    assert table.columns == [*HEADER.split(","), ingest.RESCUED, "tier"]
    assert dict(table.dtypes)["quantity"] == "int" and dict(table.dtypes)["selling_price"] == "decimal(10,2)"
    rows = {r.transaction_id: r for r in table.collect()}
    assert sorted(rows) == ["t1", "t2", "t3", "t4"] and table.count() == 4
    assert (rows["t1"].opportunity_name, rows["t1"].discount_amount, rows["t1"].tier) == ("Deal, big", None, None)
    assert (rows["t2"].quantity, rows["t2"][ingest.RESCUED]) == (None, '{"quantity":"many"}')
    assert rows["t1"][ingest.RESCUED] is None
    assert rows["t3"].tier == "gold"
    assert (rows["t4"].store_id, rows["t4"].quantity, rows["t4"].payment_mode) == ("s1", 2, "Cash")

    cleaned = silver.transactions(table, flag_failures=True)
    assert {r.transaction_id: r.parse_failures for r in cleaned.collect()}["T2"] == ["quantity"]


def test_files_are_taken_in_bounded_batches(spark, drops):
    for i in range(5):
        put(drops, f"{i}.csv", HEADER, line(f"t{i}"))
    bounded = ingest.CsvDrops(drops.source, drops.table, drops.state, max_files=2)
    ingest.run(spark, bounded)
    folders = [d for d in os.listdir(drops.table) if d.startswith(ingest.BATCH)]
    assert len(folders) == 3 and ingest.read_table(spark, bounded).count() == 5


def test_headers_of_many_files_cost_one_scan(spark, drops):
    for i in range(60):
        put(drops, f"{i:02d}.csv", HEADER + (",tier" if i % 3 else ""), line(f"t{i}", more=",gold" if i % 3 else ""), line(f"u{i}", more=",x" if i % 3 else ""))
    put(drops, "empty.csv")
    put(drops, "odd name+%20ü.csv", "", '"transaction_id",store_id,,store_id', "t99,s1,x,s2")
    paths = sorted(os.path.join(drops.source, n) for n in os.listdir(drops.source))
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        found = ingest.headers(spark, paths)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    assert len(jobs) <= 3  # the parts of one query, however many files
    assert len(found) == 61 and sum("tier" in c for c in found.values()) == 40
    assert found[paths[-1]] == tuple(spark.read.csv(paths[-1], header=True).columns) == ("transaction_id", "store_id1", "_c2", "store_id3")
    ingest.run(spark, drops)
    table = ingest.read_table(spark, drops)
    assert table.count() == 121 and table.where("tier = 'gold'").count() == 40
    assert table.where("transaction_id = 't99'").head().store_id1 == "s1"


def test_repeating_a_batch_adds_nothing(spark, drops):
    put(drops, "a.csv", HEADER, line("t1"))
    paths = spark.createDataFrame([(os.path.join(drops.source, "a.csv"),)], "path string")
    for _ in range(2):
        ingest._take(spark, drops, paths, 0)
    assert ingest.read_table(spark, drops).count() == 1


def sales_spec(tmp_path):
    return streams.SilverStream("transactions", silver.transactions, str(tmp_path / "silver"), str(tmp_path / "ss"), key="transaction_id")


def bring_up(spark, drops, spec):
    ingest.run(spark, drops)
    streams.run_committed(spark, drops, spec, ("transaction_timestamp", "quantity"))
    return sorted(str(r.transaction_id) for r in streams.first_arrivals(spec).read(spark).collect())


def forget_commits(folder):
    """As if the run had ended before the stream noted its batch."""
    commits = os.path.join(folder, "checkpoint", "commits")
    for name in os.listdir(commits):
        if name.strip(".").split(".")[0].isdigit():
            os.remove(os.path.join(commits, name))


def test_restart_between_record_and_checkpoint(spark, drops, tmp_path):
    put(drops, "a.csv", HEADER, line("t1"), line("t2"))
    spec = sales_spec(tmp_path)
    assert bring_up(spark, drops, spec) == ["T1", "T2"]
    for folder in (drops.state, spec.state):
        forget_commits(folder)
        assert bring_up(spark, drops, spec) == ["T1", "T2"]
    assert ingest.read_table(spark, drops).count() == 2


def test_a_batch_that_died_half_way_is_not_seen(spark, drops, tmp_path):
    put(drops, "a.csv", HEADER, line("t1"))
    spec = sales_spec(tmp_path)
    assert bring_up(spark, drops, spec) == ["T1"]
    # Half of the files of the next batch, in Bronze and in Silver, without a record.
    half = ingest.read_table(spark, drops).limit(1).withColumn("transaction_id", F.lit("t2"))
    half.write.parquet(f"{drops.table}/{ingest.BATCH}=1")
    streams.first_arrivals(spec).store.write(silver.transactions(half), "rows", 1)
    assert ingest.read_table(spark, drops).count() == 1 and bring_up(spark, drops, spec) == ["T1"]
    put(drops, "b.csv", HEADER, line("t2"), line("t3"), line("t1"))
    assert bring_up(spark, drops, spec) == ["T1", "T2", "T3"]
    assert ingest.read_table(spark, drops).count() == 4  # t1 came twice
    records = ingest.committed(spark, drops)
    assert [r["batch"] for r in records] == [0, 1] and all(r["files"] for r in records)


def test_a_lost_schema_is_told(spark, drops):
    put(drops, "a.csv", HEADER, line("t1"))
    ingest.run(spark, drops)
    for folder, _, names in os.walk(drops.schema_path):
        for name in names:
            os.remove(os.path.join(folder, name))
    with pytest.raises(ValueError, match="schema is gone"):
        ingest.read_table(spark, drops)


def test_nothing_ingested_yet(spark, drops):
    with pytest.raises(ValueError):
        ingest.read_table(spark, drops)


def test_stream_equals_batch(spark, drops, tmp_path):
    spec = sales_spec(tmp_path)
    put(drops, "a.csv", HEADER, line(" t1 "), line("t1"), line("t2", quantity="0"))
    bring_up(spark, drops, spec)
    put(drops, "b.csv", HEADER, line("T1"), line("t3"), line("null"), line("null"))
    bring_up(spark, drops, spec)
    assert bring_up(spark, drops, spec) == ["None", "T1", "T2", "T3"]

    got = streams.first_arrivals(spec).read(spark).drop("processed_at")
    batch = cdc.deduplicate(silver.transactions(ingest.read_table(spark, drops)), "transaction_id", ["quantity"])
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.drop("processed_at").collect()))

    measured = {r.expectation: (r.passed, r.failed) for r in streams.read_metrics(spark, spec).collect()}
    direct = quality.measure(got, quality.load_expectations("transactions"))
    assert measured == {r.expectation: (r.passed, r.failed) for r in direct.collect()}
    assert measured["valid_quantity"] == (3, 1)


def test_following_nothing(spark, drops, tmp_path):
    spec = sales_spec(tmp_path)
    streams.run_committed(spark, drops, spec, ())
    with pytest.raises(ValueError, match="no table"):
        streams.first_arrivals(spec).read(spark)


@pytest.mark.parametrize("dataset", ["inventory", "opportunity", "product_catalog"])
def test_builders_also_run_on_streams(spark, tmp_path, dataset):
    from lakemart import contracts

    ddl = getattr(contracts, f"BRONZE_{dataset.upper()}")
    width = len(contracts.names(ddl))
    rows = spark.createDataFrame([tuple([None] * width)] * 3, ddl)
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    spec = streams.SilverStream(dataset, silver.BUILDERS[dataset], str(tmp_path / "out"), str(tmp_path / "state"))
    streams.run(stream, spec)
    assert streams.read_table(spark, spec).columns == silver.BUILDERS[dataset](rows).columns
    assert streams.read_table(spark, spec).count() == 3


def test_state_can_be_bounded_by_event_time(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", datetime(2025, 1, 1)), ("a", datetime(2025, 1, 2)), ("b", datetime(2025, 1, 1))], "k string, at timestamp"
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    spec = streams.SilverStream("transactions", lambda df: df, "", "", key="k", event_time="at", within="3 days")
    query = streams.rows(stream, spec).writeStream.format("memory").queryName("bounded").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.k for r in spark.table("bounded").collect()) == ["a", "b"]


def test_compressed_deliveries(spark, drops):
    put(drops, "a.csv", HEADER, line("t1"))
    rows = spark.createDataFrame([("t2", "gold"), ("t3", None)], "transaction_id string, tier string")
    rows.coalesce(1).write.mode("append").option("maxRecordsPerFile", 1).csv(f"{drops.source}/more", header=True, nullValue="null", compression="gzip")
    ingest.run(spark, drops)
    table = ingest.read_table(spark, drops)
    assert {(r.transaction_id, r.tier) for r in table.collect()} == {("t1", None), ("t2", "gold"), ("t3", None)}


def test_headers_sort_no_lines(spark, drops, monkeypatch):
    """A compressed file is one piece: all of its lines would be sorted in one task."""
    put(drops, "a.csv", HEADER, line("t1"))
    plans = []
    kind = type(spark.range(0))
    collect = kind.collect

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)

    monkeypatch.setattr(kind, "collect", seen)
    assert len(ingest.headers(spark, [os.path.join(drops.source, "a.csv")])) == 1
    assert plans and not any("Sort" in p for p in plans)
