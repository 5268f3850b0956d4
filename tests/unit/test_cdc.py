import random
from datetime import datetime, timedelta
from itertools import groupby

from pyspark.sql import functions as F

from lakemart.operators import cdc

FEED = "op string, seq timestamp, k string, v string"


def brute_history(rows):
    """One key at a time, change after change."""
    out = []
    for key, group in groupby(sorted(rows, key=lambda r: (r[2], r[1])), key=lambda r: r[2]):
        changes = []
        for _, same in groupby(group, key=lambda r: r[1]):
            # A delete wins, then the greatest row.
            changes.append(max(same, key=lambda r: (r[0] == "D", r[0], r[3] is not None, r[3] or "")))
        kept = []
        for op, seq, _, v in changes:
            state = ("D",) if op == "D" else ("V", v)
            if not kept or kept[-1][1] != state:
                kept.append((seq, state))
        for (seq, state), after in zip(kept, [*[s for s, _ in kept[1:]], None]):
            if state[0] != "D":
                out.append((key, state[1], seq, after))
    return sorted(out, key=str)


def feed_rows(seed, n=400):
    rnd = random.Random(seed)
    start = datetime(2025, 1, 1)
    # One key gets a third of all changes.
    keys = ["hot"] + [f"k{i}" for i in range(30)]
    return [
        (
            rnd.choice("IUUUD"),
            start + timedelta(hours=rnd.randrange(0, 24 * 20)),
            "hot" if rnd.random() < 0.33 else rnd.choice(keys),
            rnd.choice(["a", "b", "c", None]),
        )
        for _ in range(n)
    ]


def test_history_matches_brute_force(spark):
    for seed in (1, 2):
        rows = feed_rows(seed)
        got = cdc.history(spark.createDataFrame(rows, FEED), ["k"]).collect()
        assert sorted(((r.k, r.v, r["__START_AT"], r["__END_AT"]) for r in got), key=str) == brute_history(rows)


def test_history_does_not_depend_on_the_chunk(spark):
    feed = spark.createDataFrame(feed_rows(3), FEED)
    plain = lambda df: sorted(map(str, df.collect()))
    whole = cdc.history(feed, ["k"], chunk=F.lit(0))
    fine = cdc.history(feed, ["k"], chunk=F.date_trunc("hour", F.col("seq")))
    assert plain(whole) == plain(fine)


def test_rows_without_key_stay(spark):
    day = datetime(2025, 1, 1)
    out = cdc.history(spark.createDataFrame([("I", day, None, "x")], FEED), ["k"]).collect()
    assert [(r.k, r.v, r["__END_AT"]) for r in out] == [(None, "x", None)]


def test_current_state(spark):
    rows = feed_rows(5)
    got = {r.k: r.v for r in cdc.current_state(spark.createDataFrame(rows, FEED), ["k"]).collect()}
    want = {}
    for key, group in groupby(sorted(rows, key=lambda r: r[2]), key=lambda r: r[2]):
        last = max(group, key=lambda r: (r[1], r[0], r[3] is not None, r[3] or ""))
        if last[0] != "D":
            want[key] = last[3]
    assert got == want


def test_deduplicate(spark):
    df = spark.createDataFrame(
        [("a", 2), ("a", 1), ("b", 5), (None, 9), (None, 8), (None, 8)], "k string, n int"
    )
    assert sorted(map(str, (tuple(r) for r in cdc.deduplicate(df, "k", ["n"]).collect()))) == sorted(
        map(str, [("a", 1), ("b", 5), (None, 8)])
    )
    kept = cdc.deduplicate(df, "k", ["n"], keep_null_keys=True)
    assert kept.filter("k IS NULL").count() == 3 and kept.count() == 5


def test_deduplicate_limits_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 as k", "id as n")
    plan = cdc.deduplicate(df, "k", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_table_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (5, "e")], "id int, v string")
    got = {(r.change_type, r.id, r.v) for r in cdc.table_diff(old, new, "id").collect()}
    assert got == {("update", 2, "B"), ("delete", 4, "d"), ("insert", 5, "e")}


def test_a_large_feed_is_dealt_to_more_tasks(spark, tmp_path):
    from lakemart.sources.tables import pieces

    feed = spark.createDataFrame([("a", 1, "I"), ("a", 2, "U"), ("b", 1, "I"), ("b", 2, "D"), (None, 1, "I")], "k string, seq int, op string")
    assert pieces(feed) is None  # of unknown size
    feed.write.parquet(str(tmp_path / "feed"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    assert pieces(feed) is None  # the session's number is enough
    wanted = pieces(feed, each=500)
    assert 4 < wanted <= 32 * 4
    dealt = cdc.current_state(feed, ["k"], pieces=wanted)
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, dealt.collect()), key=str) == sorted(map(tuple, cdc.current_state(feed, ["k"]).collect()), key=str)


def test_a_large_feed_is_dealt_out_however_many_pieces_the_session_has(spark, tmp_path):
    """Adaptive execution would merge the session's pieces into a few large ones."""
    from lakemart.sources.tables import pieces

    spark.range(20_000).selectExpr("id AS k", "id % 7 AS seq", "'I' AS op").write.parquet(str(tmp_path / "feed"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        wanted = pieces(feed, each=2000)
        assert wanted and 8 < wanted <= 1000
        assert cdc.current_state(feed, ["k"], pieces=wanted).rdd.getNumPartitions() == wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def test_deduplicate_large_tables_without_sorting_input_pieces(spark):
    rows = [("a", 2), ("a", 1), ("b", 1), (None, 9), (None, 3), (" ", 4), (" ", 2), ("", 5)]
    df = spark.createDataFrame(rows, "k string, n int")
    out = cdc.deduplicate(df, "k", ["n"], pieces=6)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, cdc.deduplicate(df, "k", ["n"]).collect()), key=str)
    kept = cdc.deduplicate(df, "k", ["n"], keep_null_keys=True, pieces=6)
    assert sorted(r.n for r in kept.collect()) == sorted(r.n for r in cdc.deduplicate(df, "k", ["n"], keep_null_keys=True).collect())
    assert out.rdd.getNumPartitions() == 6
