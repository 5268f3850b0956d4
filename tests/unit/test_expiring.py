import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from lakemart.streaming.committed import CommittedParts
from lakemart.streaming.expiring import ExpiringDedup

START = datetime(2025, 1, 1)
HOUR = timedelta(hours=1)


def windows(events, hours):
    """The same by a loop over each key's events in order."""
    by_key, out = defaultdict(list), []
    for key, at in events:
        by_key[key].append(at)
    out += [(None, at, 0) for at in by_key.pop(None, [])]
    for key, times in by_key.items():
        first = None
        for at in sorted(times):
            if first is None or at >= first + hours * HOUR:
                out += [] if first is None else [(key, first, n)]
                first, n = at, 0
            else:
                n += 1
        out.append((key, first, n))
    return sorted(out, key=repr)


@pytest.fixture
def stream(spark, tmp_path):
    dedup = ExpiringDedup("k", "at", 5 * 3600)
    table = CommittedParts(str(tmp_path / "table"), ("k",), 4)

    def deliver(*events):
        spark.createDataFrame(list(events), "k string, at timestamp").coalesce(2).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema("k string, at timestamp").parquet(str(tmp_path / "in"))
        return dedup.run(source, table, str(tmp_path / "cp"))

    return deliver, lambda: sorted(map(tuple, dedup.read(spark, table).collect()), key=repr)


def test_any_cut_gives_the_same_windows_and_state_falls(stream):
    deliver, read = stream
    draw = random.Random(1)
    times = sorted(START + timedelta(minutes=draw.randrange(60 * 48)) for _ in range(300))
    events = [(draw.choice(["hot", "hot", None, *(f"k{i}" for i in range(20))]), at) for at in times]
    sizes = []
    for low in range(0, 300, 100):
        sizes += deliver(*events[low : low + 100])
    assert max(sizes) > 10
    sizes = deliver(("end", START + 1000 * HOUR))
    assert sizes[-1] == 1  # all windows but the last event's have ended
    assert read() == windows(events, 5)


def test_ends_and_gaps(stream):
    deliver, read = stream
    at = [START + h * HOUR for h in (0, 4.999, 5, 9.9, 20)]
    deliver(*[("a", t) for t in at[:2]], ("a", at[0]))
    deliver(*[("a", t) for t in at[2:]])
    deliver(("z", START + 100 * HOUR))
    assert sorted(read(), key=lambda r: r[1]) == [("a", at[0], 2), ("a", at[2], 1), ("a", at[4], 0)]


def test_a_session_with_the_default_state_store(spark, stream):
    deliver, read = stream
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.unset(provider)  # what a session has that was not built by this package
    try:
        deliver(("a", START), ("a", START + HOUR), (None, START))
        deliver(("z", START + 100 * HOUR))
    finally:
        spark.conf.set(provider, before)
    assert read() == sorted([("a", START, 1), (None, START, 0)], key=repr)
