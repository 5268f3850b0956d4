"""Source divergence, content sort and centroids against plain Python, odd inputs included."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from lakemart.llm import centroids, content_sort, source_divergence

DOCS = "doc_id long, text string, lang string, source string, tid long, norm string, pid int, size long, __id string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 7, "norm", 3, 9, "x") for r in rows], DOCS)


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check_groups(spark, rows, partitions=None):
    found = sorted(map(tuple, content_sort.content_groups(frame(spark, rows).repartition(3), partitions=partitions).collect()), key=repr)
    groups = {}
    for row in rows:
        groups.setdefault(norm(row[1]), []).append(row[0])
    expected = []
    for text, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected += [(i, ids[0], len(ids), at == 0, digest) for at, i in enumerate(ids)]
    assert found == sorted(expected, key=repr)


@pytest.mark.parametrize("partitions", [1, 2, 7, 40])
def test_content_groups(spark, partitions):
    draw = random.Random(partitions)
    texts = ["", " ", None, "a", "a ", "a\t\tb", "a b", "a\n b", " a b", "x" * 40, "x" * 41, "ü" * 40, "é\x0b\x0cé", "long " * 60_000, "long " * 59_999]
    rows = [(i, draw.choice(texts), "en", "s") for i in range(120)]
    rows += [(1000 + i, "one hot  text" if i % 2 else "one hot text", None, None) for i in range(200)]
    rows += [(None, "a", "en", "s"), (None, "only\tnull id", "en", "s"), (5, rows[5][1], "en", "s"), (5, rows[5][1], "en", "s")]
    check_groups(spark, rows, partitions)


def test_content_groups_of_one_text(spark):
    check_groups(spark, [(i % 50, "same", "en", "s") for i in range(100)], 9)
    check_groups(spark, [(3, None, "en", "s")])
    check_groups(spark, [])


def test_normalised_texts_reach_their_neighbour_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        check_groups(spark, [(i, f"text {i // 7}", "en", "s") for i in range(100)], 4)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def audited(rows):
    """The audit by loops over all terms."""
    docs = [(lang or "", source or "", [_small(t) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = [t for t, n in df.items() if n >= 10]
        counts = {s: Counter() for s in {d[1] for d in own}}
        for _, source, terms in own:
            counts[source].update(t for t in terms if df[t] >= 10)

        def scaled(count):
            total = sum(count.values()) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // total for t in kept}

        whole = scaled(sum(counts.values(), Counter()))
        ps = {s: scaled(c) for s, c in counts.items()}
        for s, p in ps.items():
            pairs = [(sum((p[t] - q[t]) ** 2 // (p[t] + q[t]) for t in kept), o) for o, q in ps.items() if o != s]
            terms = [((p[t] - whole[t]) ** 2 // (p[t] + whole[t]), t) for t in kept if counts[s][t] and p[t] > whole[t]]
            for part, values, most in (("pair", pairs, len(pairs)), ("term", terms, 10)):
                values.sort(key=lambda v: (-v[0], v[1].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(values[:most], 1)]
    return sorted(out)


def _small(term):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in term)


@pytest.mark.parametrize("blocks", [(64, 2048), (2, 3), (1, 1)])
def test_source_divergence(spark, blocks, monkeypatch):
    monkeypatch.setattr(source_divergence, "PIECE", 50)
    monkeypatch.setattr(source_divergence, "ENTRIES", 40)
    draw = random.Random(4)
    words = ["alpha", "Beta", "GAMMA", "δέλτα", "Écl", "écl", "it's", "x1y", "rare" + "ly", " nb"] + [f"w{c}" for c in "abcdefgh"]
    rows = []
    for i in range(150):
        lang = draw.choice(["en", "en", "en", "de", None])
        text = " ".join(draw.choice(words) for _ in range(draw.randrange(30)))
        rows.append((i, draw.choice([text, text, text, None, "", "123 ?"]), lang, draw.choice(["a", "b", "c", "d", "e", None, "hot", "hot", "hot"])))
    rows += [(200, "alpha " * 5000, "en", "long"), (7, rows[7][1], rows[7][2], rows[7][3]), (None, "alpha beta", "en", "a")]
    rows += [(300, "never kept", "fr", "x"), (301, None, "fr", "y"), (302, "", "it", "alone")]
    found = source_divergence.audit(frame(spark, rows).repartition(4), group_block=blocks[0], term_block=blocks[1])
    assert sorted(map(tuple, found.collect())) == audited(rows)


def test_source_divergence_of_nothing(spark):
    assert source_divergence.audit(frame(spark, [])).collect() == []


def test_probabilities_beyond_64_bits(spark):
    row = spark.sql("SELECT 9000000000000 AS n, 90000000000001L AS total, 3L AS v").select(source_divergence.probability("n", "total", "v").alias("p")).first()
    assert row.p == 1 + 10**9 * (9_000_000_000_000 + 2) // (90_000_000_000_001 + 6)


def clustered(rows, k, rounds):
    """Clusters by all distances, in Python's whole numbers."""
    kept = [(i, [int(np.floor(256 * float(x))) for x in e]) for i, e in rows if e is not None and len(e) == 4 and all(x is not None and np.isfinite(x) for x in e)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    points = [list(v) for _, v in first]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, p)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for c, group in members.items():
            points[c] = [sum(x) // len(group) for x in zip(*group)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    whole = sum(d for *_, d in found)
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    names = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted([(i, c, d, inertia[c], whole, names[c]) for i, c, d in found], key=repr)


VECTORS = "vec_id long, embedding array<float>, v string, cluster int, distance string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, "v", 1, "far") for i, e in rows], VECTORS)


@pytest.mark.parametrize(("k", "spread"), [(1, 1.0), (6, 1.0), (12, 0.01), (300, 0.02)])
def test_clusters(spark, k, spread):
    draw = np.random.default_rng(k)
    rows = [(i, [float(np.float32(x)) for x in draw.normal(0, spread, 4)]) for i in range(150)]
    rows += [(500 + i, [0.25, 0.0, -0.25, 1.0]) for i in range(60)]  # one vector many times
    rows += [(1, rows[1][1]), (1, rows[2][1]), (None, rows[3][1]), (None, rows[4][1])]
    rows += [(900, None), (901, []), (902, [1.0] * 3), (903, [1.0] * 5), (904, [1.0, None, 1.0, 1.0]), (905, [1.0, float("nan"), 1.0, 1.0]), (906, [float("-inf")] * 4)]
    found = centroids.cluster(vectors(spark, rows).repartition(3), dimensions=4, k=k, rounds=3)
    assert sorted(map(tuple, found.collect()), key=repr) == clustered(rows, k, 3)


def test_clusters_of_nothing(spark):
    assert centroids.cluster(vectors(spark, [])).collect() == []
    assert centroids.cluster(vectors(spark, [(1, None)])).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_component_too_large(spark):
    with pytest.raises(Exception, match="would not fit into 64 bits"):
        centroids.cluster(vectors(spark, [(1, [1e9] * 4)]), dimensions=4).collect()


def test_search_prunes_and_breaks_ties():
    draw = np.random.default_rng(1)
    points = draw.integers(-5, 6, (40, 3))  # many equal distances
    points[7] = points[3]
    queries = draw.integers(-6, 7, (3000, 3))
    gap = queries[:, None, :] - points[None]
    every = (gap * gap).sum(axis=2)
    best, least = centroids.Centroids(points).nearest(queries)
    assert (best == every.argmin(axis=1)).all()
    assert (least == every.min(axis=1)).all()
    far = np.array([[0, 0], [1000, 0], [1001, 0], [0, 2000]])
    search = centroids.Centroids(far)
    tried = []
    search.points = _Watched(far, tried)
    assert search.nearest(np.array([[1001, 1]]))[0].tolist() == [2]
    assert 3 not in tried  # beyond twice the distance of the best


class _Watched:
    """Centroids that note which of them are compared."""

    def __init__(self, points, tried):
        self.points, self.tried = points, tried

    def __len__(self):
        return len(self.points)

    def __getitem__(self, at):
        self.tried += np.atleast_1d(at).tolist()
        return self.points[at]
