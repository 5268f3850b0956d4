"""Substring dedup against a dictionary of all windows."""

import hashlib
import random
import time
from collections import Counter

import pytest

from lakemart.llm import substring_dedup


def plain(rows, window):
    """(id, n_words, n_removed, digest) by looking at every window."""
    texts = [(i, [w for w in substring_dedup.doc_words(t or "")]) for i, t in rows]
    seen = Counter(tuple(w[k : k + window]) for _, w in texts for k in range(len(w) - window + 1))
    out = []
    for i, words in texts:
        gone = set()
        for k in range(len(words) - window + 1):
            if seen[tuple(words[k : k + window])] > 1:
                gone.update(range(k, k + window))
        left = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def removed(spark, rows, window):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(map(tuple, substring_dedup.remove_repeated(docs, window, digests=True).collect()), key=repr)


def make(seed):
    draw = random.Random(seed)
    passage = [f"p{i}" for i in range(90)]
    rows = []
    for i in range(60):
        words = [f"w{draw.randrange(60 if i % 3 else 10**6)}" for _ in range(draw.randrange(160))]
        if i % 4 == 0:
            at = draw.randrange(len(words) + 1)
            words[at:at] = passage[draw.randrange(40) :]
        rows.append((i, draw.choice([" ", "  ", "\n"]).join(words)))
    rows += [(100, "a b c " * 60), (101, "a b c " * 45 + "end"), (102, "x " * 200), (103, None), (104, ""), (None, rows[0][1]), (None, rows[1][1])]
    rows += [(200 + i, " ".join(passage)) for i in range(30)]  # copies under ids of their own
    rows += [rows[2]] * 3 + [rows[5]] + [(None, rows[0][1])]  # equal rows
    return rows


@pytest.mark.parametrize(("window", "shard", "hot"), [(35, 20_000, 1e-4), (8, 20_000, 1e-4), (8, 3, 1e-2), (12, 3, 1e-3)])
def test_same_as_all_windows(spark, monkeypatch, window, shard, hot):
    monkeypatch.setattr(substring_dedup, "SHARD_SEGMENTS", shard)
    rows = make(window + shard)
    assert removed(spark, rows, window) == plain(rows, window)


def test_equal_rows_take_no_longer_than_others(spark):
    text = " ".join(f"w{i}" for i in range(200))
    start = time.perf_counter()
    found = removed(spark, [(1, text)] * 3000, 35)
    assert found == [(1, 200, 200, hashlib.sha256(b"").hexdigest())] * 3000
    assert time.perf_counter() - start < 60
