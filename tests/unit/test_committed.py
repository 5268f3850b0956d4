import itertools
import random
from datetime import datetime, timedelta

import pytest
from lakemart.operators import cdc
from lakemart.sources import files
from lakemart.streaming import committed as C

FEED = "op string, seq timestamp, k string, v int, w string"
DAY = datetime(2025, 1, 1)


def make_feed(seed, keys=12, n=70):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        k = rnd.choice([*(f"k{i}" for i in range(keys)), "hot", "hot", "hot", None])
        at = DAY + timedelta(hours=rnd.randrange(24 * 6))
        rows.append((rnd.choice("IUUUD"), at, k, rnd.choice([1, 2, None]), rnd.choice(["x", None])))
    return rows


def plain(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def store(path, parts=4):
    return C.CommittedParts(str(path), ("k",), parts)


@pytest.mark.parametrize("seed", range(4))
def test_any_order_and_any_cut_gives_the_batch_result(spark, tmp_path, seed):
    rows = make_feed(seed)
    whole = spark.createDataFrame(rows, FEED)
    random.Random(seed).shuffle(rows)
    cuts = sorted(random.Random(seed + 9).sample(range(1, len(rows)), 3))
    history, current = C.History(store(tmp_path / "h")), C.CurrentState(store(tmp_path / "c"))
    for number, (low, high) in enumerate(itertools.pairwise([0, *cuts, len(rows)])):
        part = spark.createDataFrame(rows[low:high], FEED)
        for target in (history, current):
            target.apply(part, number)
            target.apply(part, number)  # a repeated batch
    assert plain(history.read(spark)) == plain(cdc.history(whole, ["k"]))
    assert plain(current.read(spark)) == plain(cdc.current_state(whole, ["k"]))


def intervals(spark, target):
    return [(r.v, r["__START_AT"].day, r["__END_AT"].day) for r in target.read(spark).orderBy("__START_AT").collect()]


def test_a_late_change_splits_a_closed_interval(spark, tmp_path):
    target = C.History(store(tmp_path / "h"))

    def at(day, v, op="U"):
        return (op, DAY + timedelta(days=day), "a", v, "x")

    target.apply(spark.createDataFrame([at(0, 1, "I"), at(10, 2), at(20, 2), at(30, 2, "D")], FEED), 0)
    assert intervals(spark, target) == [(1, 1, 11), (2, 11, 31)]
    target.apply(spark.createDataFrame([at(15, 3)], FEED), 1)
    assert intervals(spark, target) == [(1, 1, 11), (2, 11, 16), (3, 16, 21), (2, 21, 31)]  # the third change had added no row before


def test_only_touched_parts_are_written(spark, tmp_path):
    target = C.CurrentState(store(tmp_path / "c", parts=16))
    rows = [("I", DAY, f"k{i}", i, "x") for i in range(200)]
    target.apply(spark.createDataFrame(rows, FEED), 0)
    assert len(target.store.last(spark)["written"]["versions"]) == 16
    change = spark.createDataFrame([("U", DAY + timedelta(days=1), "k7", -7, "x")], FEED)
    target.apply(change, 1)
    record = target.store.last(spark)
    assert record["written"]["versions"] == target.store.touched(change) and len(record["written"]["versions"]) == 1
    assert {r.k: r.v for r in target.read(spark).collect()} == {f"k{i}": i for i in range(200)} | {"k7": -7}
    gone = target.store.vacuum(spark)
    assert len(gone) == 1 and gone[0].startswith("versions/batch=0/")
    assert target.read(spark).count() == 200 and target.store.vacuum(spark) == []


class Died(Exception):
    pass


@pytest.mark.parametrize("kind", [C.CurrentState, C.History])
def test_a_crash_between_write_and_record_changes_nothing(spark, tmp_path, monkeypatch, kind):
    target = kind(store(tmp_path / "t"))
    first = [("I", DAY, "a", 1, "x"), ("I", DAY, "b", 1, "x")]
    second = [("U", DAY + timedelta(days=1), "a", 2, "x"), ("D", DAY + timedelta(days=1), "b", 1, "x"), ("I", DAY, "c", 3, "x")]
    target.apply(spark.createDataFrame(first, FEED), 0)
    before = plain(target.read(spark))
    with monkeypatch.context() as patched:
        patched.setattr(files, "write_once", lambda *_: (_ for _ in ()).throw(Died()))
        with pytest.raises(Died):
            target.apply(spark.createDataFrame(second, FEED), 1)
    assert plain(target.read(spark)) == before
    assert target.store.vacuum(spark) == []  # what is on its way stays
    target.apply(spark.createDataFrame(second, FEED), 1)
    whole = spark.createDataFrame(first + second, FEED)
    assert plain(target.read(spark)) == plain((cdc.history if kind is C.History else cdc.current_state)(whole, ["k"]))


def test_a_feed_as_a_stream(spark, tmp_path):
    target, rows = C.History(store(tmp_path / "t")), make_feed(5)
    for part in (rows[40:], rows[:40]):
        spark.createDataFrame(part, FEED).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        C.run_changes(spark.readStream.schema(FEED).parquet(str(tmp_path / "in")), target, str(tmp_path / "cp"))
    C.run_changes(spark.readStream.schema(FEED).parquet(str(tmp_path / "in")), target, str(tmp_path / "cp"))
    assert plain(target.read(spark)) == plain(cdc.history(spark.createDataFrame(rows, FEED), ["k"]))


def test_first_arrivals_append_only(spark, tmp_path):
    target = C.FirstArrivals(store(tmp_path / "f"), ("v",))

    def batch(*rows):
        return spark.createDataFrame([(k, v) for k, v in rows], "k string, v int")

    new = []
    target.apply(batch(("a", 2), ("a", 1), (None, 5), (None, 4), ("b", 9)), 0, lambda rows: new.append(rows.count()))
    target.apply(batch(("a", 0), ("c", 3), (None, 1)), 1, lambda rows: new.append(rows.count()))
    target.apply(batch(("d", 0)), 1, lambda rows: new.append(rows.count()))  # recorded before
    target.apply(batch(), 2)
    got = sorted(((r.k or "", r.v) for r in target.read(spark).collect()))
    assert got == [("", 4), ("a", 1), ("b", 9), ("c", 3)] and new == [3, 1]


def test_records_are_whole_and_final(spark, tmp_path):
    path = str(tmp_path / "records" / "1")
    files.write_once(spark, path, "first ü")
    files.write_once(spark, path, "second")
    assert files.read_text(spark, path) == "first ü" and files.names(spark, str(tmp_path / "records")) == ["1"]
    assert files.names(spark, str(tmp_path / "none")) == [] and not files.exists(spark, str(tmp_path / "none"))


def test_reading_before_the_first_record(spark, tmp_path):
    with pytest.raises(ValueError, match="no table"):
        store(tmp_path).read(spark, "rows")
    assert not store(tmp_path).committed(spark, 0)


def test_first_arrivals_shuffle_a_batch_once_and_sort_nothing_before(spark, tmp_path, monkeypatch):
    """The limit in front of the shuffle would sort whole input pieces, the join and the write shuffle again."""
    plans, write = [], C.CommittedParts.write

    def seen(self, rows, table, batch):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(self, rows, table, batch)

    monkeypatch.setattr(C.CommittedParts, "write", seen)
    target = C.FirstArrivals(store(tmp_path / "f"), ("v",))
    batches = [[("a", 2), ("a", 1), (None, 5), (None, 4), (" ", 1)], [("a", 0), ("b", 3), ("b", 2), (None, 1), (" ", 0), ("", 7)], [("a", 9), (None, 9)]]
    for few in (C.FEW_BYTES, 0):
        target = C.FirstArrivals(store(tmp_path / f"f{few}"), ("v",))
        monkeypatch.setattr(C, "FEW_BYTES", few)
        for number, rows in enumerate(batches):
            spark.createDataFrame(rows, "k string, v int").write.parquet(str(tmp_path / f"in{few}-{number}"))
            target.apply(spark.read.parquet(str(tmp_path / f"in{few}-{number}")), number)
        got = sorted(target.read(spark).collect(), key=str)
        assert [tuple(r) for r in got] == sorted([("a", 1), (None, 4), (" ", 1), ("b", 2), ("", 7)], key=str)
        assert sorted(r.v for r in target.read(spark).collect()) == [1, 1, 2, 4, 7]
    first = plans[0].split("Window ")[1]  # below the last window
    assert plans[0].count("_share") and "REBALANCE" not in plans[0] and "SortMergeJoin" not in "".join(plans)
    assert all("rebalance" not in p.lower() for p in plans) and "Exchange hashpartitioning(_part" in first
