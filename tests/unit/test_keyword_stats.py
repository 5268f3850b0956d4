import random

import pytest
from pyspark.sql import functions as F

from lakemart.operators import cdc
from lakemart.operators import keyword_stats as S

SCHEMA = "chunk_id string, chunk_to_retrieve string, colour string"


def rows_of(df):
    return {(r.statistic, r.term): r.value for r in df.collect()}


def make(spark, texts):
    return spark.createDataFrame([(k, t, "red") for k, t in texts.items()], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", range(3))
def test_synced_statistics_equal_a_recount(spark, seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(30)]

    def text():
        return rnd.choice([" ".join(rnd.choices(words, k=rnd.randrange(1, 12))), "", None, "once" + str(rnd.random())])

    state = {f"k{i}": text() for i in range(60)}
    table = make(spark, state)
    known = S.statistics(table)
    for _ in range(3):
        after = {k: v for k, v in state.items() if rnd.random() > 0.15}
        after |= {k: text() for k in after if rnd.random() < 0.2}
        after |= {f"k{rnd.randrange(60, 200)}": text() for _ in range(8)}
        new = make(spark, after)
        synced = S.sync_statistics(known, table, new).collect()
        known = spark.createDataFrame(synced, "statistic string, term string, value long")
        assert rows_of(known) == rows_of(S.statistics(new))
        state, table = after, new


def test_figures(spark):
    table = make(spark, {"a": "Big chairs, big tables", "b": "chairs", "c": "", "d": None})
    assert rows_of(S.statistics(table)) == {
        ("documents", None): 3, ("words", None): 5, ("document_frequency", "big"): 1,
        ("document_frequency", "chairs"): 2, ("document_frequency", "tables"): 1,
    }
    assert rows_of(S.sync_statistics(S.statistics(table), table, table.limit(0))) == {}
    assert rows_of(S.sync_statistics(S.statistics(table.limit(0)), table.limit(0), table)) == rows_of(S.statistics(table))


def expected_diff(old, new):
    kinds = {k: "insert" for k in new if k not in old} | {k: "delete" for k in old if k not in new}
    kinds |= {k: "update" for k in new if k in old and old[k] != new[k]}
    return {(kind, k, *(old if kind == "delete" else new)[k]) for k, kind in kinds.items()}


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_table_diff(spark, buckets):
    rnd = random.Random(buckets)
    old = {i: (rnd.choice(["x", "", None]), rnd.choice([1.5, None])) for i in range(200)} | {None: ("null key", 1.0), 1000: (None, 1.5), 1001: ("stays", None)}
    new = {k: v for k, v in old.items() if k is None or k % 7} | {i: ("new", 2.0) for i in range(190, 230)} | {1000: ("", 1.5), None: ("null key", 2.0)}
    frames = [spark.createDataFrame([(k, *v) for k, v in t.items()], "id long, a string, b double") for t in (old, new)]
    got = cdc.table_diff(*frames, "id", buckets)
    assert got.columns == ["change_type", "id", "a", "b"]
    assert {tuple(r) for r in got.collect()} == expected_diff(old, new)
    assert cdc.table_diff(frames[0], frames[0], "id", buckets).count() == 0


def test_only_unequal_buckets_are_joined(spark, tmp_path):
    """One changed row of many: one bucket's rows reach the joins."""
    spark.range(5000).withColumn("v", F.col("id") * 2).repartition(4).write.parquet(str(tmp_path / "old"))
    old = spark.read.parquet(str(tmp_path / "old"))
    new = old.withColumn("v", F.when(F.col("id") == 77, -1).otherwise(F.col("v"))).repartition(3)
    a, b = (cdc.digested(df, "id", ["id", "v"], 500) for df in (old, new))
    unequal = [r._bucket for r in cdc.unequal_buckets(a, b).collect()]
    assert unequal == [a.where("id = 77").head()._bucket]
    assert a.where(F.col("_bucket").isin(unequal)).count() < 40
    assert [tuple(r) for r in cdc.table_diff(old, new, "id", 500).collect()] == [("update", 77, -1)]


def test_signed_changes_turn_one_table_into_the_other(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "id int, v string")
    got = {tuple(r) for r in cdc.signed_changes(old, new, "id").collect()}
    assert got == {(2, "b", -1), (3, "c", -1), (2, "B", 1), (4, "d", 1)}
