"""Near-dedup against all pairs with a common shingle."""

import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from lakemart.llm import near_dedup


def exact_links(texts, known):
    """Pairs of texts with a weighted Jaccard similarity of SIMILAR or more."""
    sets = [near_dedup.weighted(t, known) for t in texts]
    holders = defaultdict(list)
    for i, (hashes, _) in enumerate(sets):
        for h in hashes.tolist():
            holders[h].append(i)
    pairs = {(a, b) for rows in holders.values() for n, b in enumerate(rows) for a in rows[:n]}
    return {(a, b) for a, b in pairs if near_dedup.weighted_jaccard(sets[a], sets[b]) >= near_dedup.SIMILAR}


def joined(links, n):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for a, b in links:
        label[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(n)]


def check(spark, docs, recall):
    """Classes hold only what links join, and most of what links join."""
    df = spark.createDataFrame([(i, t) for i, t in docs.items()], "doc_id long, text string").repartition(4)
    known = near_dedup.frequencies(near_dedup.nodes_of(df, "doc_id", "text"))
    texts = sorted({t for t in docs.values() if t and t.split()})
    links = exact_links(texts, known)
    whole = dict(zip(texts, joined(links, len(texts))))
    found = {r.doc_id: r.class_id for r in near_dedup.near_classes(df).collect()}
    assert sorted(found) == sorted(docs)
    together = defaultdict(set)
    for i, c in found.items():
        if docs[i] and docs[i].split():
            together[c].add(whole[docs[i]])
    assert all(len(roots) == 1 for roots in together.values())  # nothing beyond the links
    first = {t: i for i, t in sorted(docs.items(), reverse=True)}
    kept = sum(found[first[texts[a]]] == found[first[texts[b]]] for a, b in links)
    assert kept >= recall * len(links) and len(links) >= 5
    return links, known


def test_sample_documents(spark):
    frame = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    check(spark, dict(zip(frame.doc_id.tolist(), frame.text.tolist())), 0.99)


@pytest.mark.parametrize("block", [8, 256])
def test_one_passage_in_many_documents(spark, monkeypatch, block):
    """Chains and groups that share a bucket without sharing a class."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    draw = random.Random(2)
    shared = [f"s{i}" for i in range(400)]
    docs = {}
    for group in range(40):  # half of each text is the shared passage
        own = [f"g{group}w{i}" for i in range(draw.choice([100, 300]))]
        for _ in range(4):
            words = own.copy()
            words[draw.randrange(len(words))] = f"new{len(docs)}"
            docs[len(docs)] = " ".join(words + shared)
    chain = [f"c{i}" for i in range(300)]
    for i in range(30):  # neighbours are alike, the ends are not
        chain[i * 9] = f"x{i}"
        docs[len(docs)] = " ".join(chain)
    docs |= {1000: None, 1001: "", 1002: docs[0], 1003: "a b", 1004: "a b", 1005: "A  b"}
    check(spark, docs, 0.97)


def test_weights_spread(spark):
    counts = np.full(near_dedup.SKETCH_ROWS << near_dedup.SKETCH_BITS, 30)
    frequent = np.array([1 << 40, 1 << 62, 12345678901234567890], dtype=np.uint64)
    for h, n in zip(frequent, (100, 5000, 90_000)):
        counts[near_dedup.cells(np.array([h], dtype=np.uint64))] += n
    known = near_dedup.Frequencies.of(counts, 100_000)
    rare = np.array([999 << 33], dtype=np.uint64)
    weight = [float(np.exp2(known.exponents(np.array([h], np.uint64), np.array([1])) / near_dedup.OCTAVE)[0]) for h in (*rare, *frequent)]
    assert weight[0] == 1 and weight == sorted(weight, reverse=True) and weight[-1] == 0.125
    twice = known.exponents(rare, np.array([2]))
    assert np.exp2(twice / near_dedup.OCTAVE)[0] == 2


def test_large_group_of_copies_stays_together(spark):
    """Copies do not make their own words common; a passage of unrelated texts does."""
    draw = random.Random(6)
    passage, source = [f"p{i}" for i in range(60)], [f"s{i}" for i in range(300)]
    docs = {i: " ".join([*passage, *(f"d{i}w{n}" for n in range(240))]) for i in range(300)}
    docs |= {i: " ".join(f"d{i}w{n}" for n in range(300)) for i in range(300, 600)}
    for i in range(1000, 1300):  # near copies and exact ones
        words = source.copy()
        if i % 3:
            for at in draw.sample(range(300), 2):
                words[at] = f"c{i}n{at}"
        docs[i] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    known = near_dedup.frequencies(near_dedup.nodes_of(df, "doc_id", "text"))
    weight = {name: near_dedup.weighted(" ".join(words), known)[1].mean() for name, words in (("passage", passage), ("source", source))}
    assert weight["passage"] < 0.5 and weight["source"] > 0.9
    found = {r.doc_id: r.class_id for r in near_dedup.near_classes(df).collect()}
    assert {found[i] for i in range(1000, 1300)} == {1000}
    assert all(found[i] == i for i in range(600))


def test_bound_does_not_rule_a_member_out(spark):
    """A member's similarity to the leader is only bounded from above, so it may be as far off as the one it is linked to."""
    words = [f"w{i}" for i in range(200)]
    texts = {b"l": " ".join(f"l{i}" for i in range(200)), b"o": " ".join(words), b"s": " ".join([*words[:-1], "end"])}
    known = near_dedup.Frequencies.of(np.zeros(near_dedup.SKETCH_ROWS << near_dedup.SKETCH_BITS), 100)
    rows = []
    for node, text in texts.items():
        hashes, times = near_dedup.shingles(text)
        numbers = near_dedup.named([near_dedup.samples(hashes, known.exponents(hashes, times))])
        rows.append((bytearray(node), near_dedup.bands(numbers)[0].tolist(), bytearray(numbers.astype(np.uint16)[0].tobytes()), text))
    near_dedup.ship(spark)
    frame = spark.createDataFrame(rows, "node binary, buckets array<long>, sketch binary, text string")
    both = rows[1][1][int(np.argmax(np.array(rows[1][1]) == np.array(rows[2][1])))]
    told = [(bytearray(b"l"), bytearray(b"o"), both, 0.3, False), (bytearray(b"l"), bytearray(b"s"), both, 0.7, True)]
    told = spark.createDataFrame(told, "leader binary, node binary, bucket long, similarity double, bound boolean")
    label = spark.createDataFrame([(bytearray(b"l"), bytearray(b"l")), (bytearray(b"s"), bytearray(b"l"))], "node binary, label binary")
    found = near_dedup._rest(told, label, frame, known).collect()
    assert [{bytes(r.a), bytes(r.b)} for r in found] == [{b"o", b"s"}]


def test_samples_agree_as_weighted_jaccard_says():
    draw = np.random.default_rng(3)
    known = near_dedup.Frequencies.of(np.zeros(near_dedup.SKETCH_ROWS << near_dedup.SKETCH_BITS), 100)
    agreed, exact = [], []
    for _ in range(300):
        words = [f"w{i}" for i in draw.integers(0, 10**6, 200)]
        other = words.copy()
        for at in draw.integers(0, 200, draw.integers(1, 12)):
            other[at] = f"n{at}"
        sets = [near_dedup.shingles(" ".join(x)) for x in (words, other)]
        steps = [known.exponents(*s) for s in sets]
        numbers = near_dedup.named([near_dedup.samples(s[0], e) for s, e in zip(sets, steps)])
        agreed.append((numbers[0] == numbers[1]).mean())
        exact.append(near_dedup.weighted_jaccard(*((s[0], np.exp2(e / near_dedup.OCTAVE)) for s, e in zip(sets, steps))))
    assert abs(np.mean(agreed) - np.mean(exact)) < 0.02
    assert np.corrcoef(agreed, exact)[0, 1] > 0.75  # 36 samples are noisy
