import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.operators import retrieval as R
from lakemart.operators.vector_index import SignIndex, planes, products, sketches
from lakemart.plans import registry

rnd = np.random.default_rng(5)
CENTRES = rnd.normal(size=(20, 64))
# Vectors around 20 centres; a third of all are copies of one; NULL and zero vectors.
VECTORS = {i: (CENTRES[i % 20] + rnd.normal(0, 0.5, 64)).tolist() for i in range(400)}
VECTORS |= {i: VECTORS[0] for i in range(400, 600)} | {600: [0.0] * 64, 601: None}
ASKED = {f"q{i}": (CENTRES[i] + rnd.normal(0, 0.3, 64)).tolist() for i in range(12)} | {"none": None}


@pytest.fixture
def tables(spark):
    queries = spark.createDataFrame(list(ASKED.items()), "question_id string, embedding array<double>")
    corpus = spark.createDataFrame(list(VECTORS.items()), "chunk_id bigint, embedding array<double>")
    return queries, corpus.repartition(4)


def cosine(a, b):
    a, b = np.array(a), np.array(b)
    size = np.linalg.norm(a) * np.linalg.norm(b)
    return round(float(a @ b / size), 6) + 0.0 if size else 0.0


def expected(index, k):
    """The same search by loops over all pairs."""

    def code(v):
        found = products(np.array([v]), planes(index.tables * index.bits, 64, "code")).reshape(index.tables, index.bits)
        own = [sum(1 << b for b in range(index.bits) if row[b] >= 0) for row in found]
        near = [sorted(range(index.bits), key=lambda b: (abs(row[b]), b))[: index.probes] for row in found]
        return own, [{o, *(o ^ (1 << b) for b in flips)} for o, flips in zip(own, near)]

    def apart(a, b):
        words = [sketches(np.array([v]), index.sketch_bits)[0] for v in (a, b)]
        return sum(int(x ^ y).bit_count() for x, y in zip(*words))

    filed = {i: code(v)[0] for i, v in VECTORS.items() if v}
    out, met, scored = set(), set(), set()
    for q, v in ASKED.items():
        if v is None:
            continue
        probed = code(v)[1]
        hit = [i for i, c in filed.items() if any(c[t] in probed[t] for t in range(index.tables))]
        met |= {(q, i) for i in hit}
        left = [i for i in hit if apart(v, VECTORS[i]) <= index.farthest]
        scored |= {(q, i) for i in left}
        best = sorted((-cosine(v, VECTORS[i]), i) for i in left)[:k]
        out |= {(q, i, -s + 0.0, r) for r, (s, i) in enumerate(best, 1)}
    return out, met, scored


@pytest.mark.parametrize("index", [SignIndex(), SignIndex(3, 7, 0, 64, 30), SignIndex(block_rows=20, query_block=3)])
def test_only_what_meets_is_scored(spark, tables, tmp_path, index):
    queries, corpus = tables
    want, met, scored = expected(index, 5)
    filed = index.write(corpus, str(tmp_path / "index"))
    got = {(r.question_id, r.chunk_id, round(r.score, 6) + 0.0, r["rank"]) for r in index.topk(queries, filed, 5).collect()}
    assert got == want
    pairs = index.met(queries, index.read(spark, str(tmp_path / "index"))).collect()
    assert {(r.question_id, r.chunk_id) for r in pairs} == met
    assert {(r.question_id, r.chunk_id) for r in pairs if r.scored} == scored


def test_blocks_bound_hot_codes(tables):
    queries, corpus = tables
    index = SignIndex(block_rows=25, query_block=2)
    rows, asked = index._cells(queries, index.filed(corpus), "question_id", "chunk_id", "embedding")
    sizes = rows.groupBy("hash_table", "code", "_rows", "_queries").count().agg(F.max("count")).head()[0]
    assert sizes < 60  # 200 copies share their codes
    assert asked.groupBy("hash_table", "code", "_rows", "_queries").count().agg(F.max("count")).head()[0] < 8


def test_prunes_near_vectors_with_whole_recall(tables, tmp_path):
    queries, corpus = tables
    index = SignIndex(bits=10)
    filed = index.write(corpus, str(tmp_path / "index"))
    exact = {(r.question_id, r.chunk_id) for r in R.vector_topk(queries, corpus, 10).collect()}
    got = {(r.question_id, r.chunk_id) for r in index.topk(queries, filed, 10).collect()}
    assert len(got & exact) >= 0.9 * len(exact)
    assert index.met(queries, filed).count() < 0.2 * 12 * 601  # pairs that meet at all


def test_recall_on_the_sample_vectors(spark, tmp_path):
    """Vectors without near neighbours, the worst case: the sketch does the pruning."""
    m = registry.medallion(spark, "/root/testdata/sf0.1")
    corpus, queries, index = m.bronze.table("embeddings").select("vec_id", "embedding"), registry._label_centres(m), SignIndex()
    filed = index.write(corpus, str(tmp_path / "index"), "vec_id")
    exact = {(r.label, r.vec_id) for r in R.vector_topk(queries, corpus, 10, "label", "vec_id").collect()}
    got = {(r.label, r.vec_id) for r in index.topk(queries, filed, 10, "label", "vec_id").collect()}
    assert len(got & exact) >= 0.9 * len(exact)
    scored = index.met(queries, filed, "label", "vec_id").where("scored").count()
    assert scored < 0.2 * queries.count() * corpus.count()


def test_exact_signs_of_large_components():
    large = np.array([[float(1 << 25)] + [0.0] * 62 + [1.0]])
    got = products(large, planes(3, 64, "code"))
    want = [[(1 << 41) * int(p[0]) + (1 << 16) * int(p[63]) for p in planes(3, 64, "code")]]
    assert got.astype(np.int64).tolist() == want


def test_no_rows_and_bad_parameters(spark, tables, tmp_path):
    queries, corpus = tables
    index = SignIndex()
    filed = index.filed(corpus)
    assert index.topk(queries.limit(0), filed, 5).count() == 0
    assert index.topk(queries, index.filed(corpus.limit(0)), 5).count() == 0
    with pytest.raises(ValueError):
        SignIndex(bits=3, probes=4)
    with pytest.raises(ValueError):
        index.topk(queries, filed, 5, "chunk_id")
