import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.operators import retrieval as R

rnd = random.Random(11)
VECTORS = {i: [rnd.gauss(0, 1) for _ in range(8)] for i in range(300)}
# A third of the corpus are copies of one vector.
VECTORS |= {i: VECTORS[0] for i in range(300, 450)}
VECTORS[450] = [0.0] * 8
QUERIES = {f"q{i}": [rnd.gauss(0, 1) for _ in range(8)] for i in range(7)} | {"same": VECTORS[0]}


def cosine(a, b):
    na, nb = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b)) / (na * nb) if na and nb else 0.0


def brute(k, corpus=VECTORS):
    out = set()
    for q, v in QUERIES.items():
        scored = sorted((-round(cosine(v, w), 6), i) for i, w in corpus.items())
        out |= {(q, i, round(-s, 6) + 0.0, r + 1) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.fixture
def tables(spark):
    queries = spark.createDataFrame(list(QUERIES.items()), "question_id string, embedding array<double>")
    corpus = spark.createDataFrame(list(VECTORS.items()), "chunk_id bigint, embedding array<double>")
    return queries, corpus.repartition(5)


def found(df):
    return {(r.question_id, r.chunk_id, round(r.score, 6) + 0.0, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("k", [1, 10, 1000])
def test_vector_topk_is_exact(tables, k):
    assert found(R.vector_topk(*tables, k)) == brute(k)


def test_many_queries_take_the_block_way(tables):
    assert found(R.vector_topk(*tables, 10, max_queries=3, block_rows=60)) == brute(10)


def test_missing_vectors_and_no_queries(spark, tables):
    queries, corpus = tables
    more = corpus.unionByName(spark.createDataFrame([(999, None)], corpus.schema))
    assert found(R.vector_topk(queries, more, 5)) == brute(5)
    assert R.vector_topk(queries.limit(0), corpus, 5).count() == 0


DOCS = {
    "a": "Chairs and tables, chairs!",
    "b": "a table for the garden",
    "c": "garden garden garden chairs",
    "d": "nothing to see",
    "e": "",
    "f": "Chairs and tables, chairs!",
}
ASKED = {1: "garden chairs", 2: "TABLES", 3: "zebra", 4: "   "}


@pytest.fixture
def texts(spark):
    docs = spark.createDataFrame(list(DOCS.items()), "chunk_id string, chunk_to_retrieve string")
    asked = spark.createDataFrame(list(ASKED.items()), "question_id int, question string")
    return asked, docs


def split(text):
    return [w for w in "".join(c if c.isalnum() else " " for c in text.lower()).split() if w]


def brute_bm25(k):
    bags = {d: Counter(split(t)) for d, t in DOCS.items()}
    n, average = len(DOCS), sum(sum(b.values()) for b in bags.values()) / len(DOCS)
    out = set()
    for q, text in ASKED.items():
        scored = []
        for d, bag in bags.items():
            score = 0.0
            for term in set(split(text)):
                df = sum(term in b for b in bags.values())
                if bag[term]:
                    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                    score += idf * bag[term] * 2.2 / (bag[term] + 1.2 * (0.25 + 0.75 * sum(bag.values()) / average))
            if score:
                scored.append((-round(score, 6), d))
        out |= {(q, d, round(-s, 6), r + 1) for r, (s, d) in enumerate(sorted(scored)[:k])}
    return out


def test_bm25(texts):
    assert found(R.bm25_topk(*texts, 3)) == brute_bm25(3)


@pytest.mark.parametrize("slice_size", [1, 2, 7])
def test_bm25_in_slices(texts, slice_size):
    assert found(R.bm25_topk(*texts, 3, slice_size=slice_size)) == brute_bm25(3)


@pytest.mark.parametrize("slice_size", [1, 100])
def test_bm25_leaves_missing_texts_out(spark, texts, slice_size):
    asked, docs = texts
    missing = docs.limit(0).unionByName(spark.createDataFrame([("none1",), ("none2",)], "chunk_id string"), allowMissingColumns=True)
    assert found(R.bm25_topk(asked, docs.unionByName(missing), 3, slice_size=slice_size)) == brute_bm25(3)


def test_postings_are_shuffled_once(texts):
    _, docs = texts
    plan = R.term_counts(docs, "chunk_id", "chunk_to_retrieve")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_embedder(spark, texts, tmp_path):
    _, docs = texts
    embedder = R.HashedEmbedder(64).fit(docs, "chunk_to_retrieve")
    got = {r.chunk_id: np.array(r.embedding) for r in embedder.embed(docs, "chunk_to_retrieve").collect()}
    assert all(len(v) == 64 for v in got.values())
    assert got["a"].tolist() == got["f"].tolist() and abs(np.linalg.norm(got["a"]) - 1) < 1e-9
    assert not got["e"].any()
    embedder.save(spark, str(tmp_path / "e"))
    again = R.HashedEmbedder.load(spark, str(tmp_path / "e"))
    assert again.weights.tolist() == embedder.weights.tolist()
    with pytest.raises(ValueError):
        R.HashedEmbedder().embed(docs, "chunk_to_retrieve")


def test_fusion(spark):
    left = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "question_id int, chunk_id string, rank int")
    right = spark.createDataFrame([(1, "b", 1), (1, "c", 2)], "question_id int, chunk_id string, rank int")
    out = [(r.chunk_id, r.score, r["rank"]) for r in R.fuse(left, right, 2, "question_id", "chunk_id").orderBy("rank").collect()]
    assert out == [("b", round(1 / 62 + 1 / 61, 9), 1), ("a", round(1 / 61, 9), 2)]


def test_hybrid_finds_both_kinds(texts):
    asked, docs = texts
    docs = docs.withColumn("chunk_to_embed", F.col("chunk_to_retrieve"))
    out = R.hybrid_topk(asked, docs, R.HashedEmbedder(64).fit(docs, "chunk_to_embed"), k=2)
    best = {r.question_id: r.chunk_id for r in out.filter("rank = 1 AND question_id < 3").collect()}
    assert best == {1: "c", 2: "a"}


def test_context(spark):
    asked = spark.createDataFrame([(1, "x"), (2, " \t\n"), (3, "y"), (4, None)], "question_id int, question string")
    hits = spark.createDataFrame(
        [
            (1, 2, "two", "", None, None, "Home"),
            (1, 1, "one", "src", "page", "P1", ""),
            (1, 10, None, None, "text", None, None),
            (2, 1, "one", "src", "page", "P1", ""),
        ],
        "question_id int, rank int, chunk_to_retrieve string, source_uri string, document_type string, product_id string, category string",
    )
    out = {r.question_id: r.context for r in R.contexts(asked, hits).collect()}
    assert out[1] == (
        "Source: src\nDocument type: page\nProduct ID: P1\nCategory: N/A\nContent:\none"
        "\n\n---\n\nSource: Unknown source\nDocument type: Unknown\nProduct ID: N/A\nCategory: Home\nContent:\ntwo"
        "\n\n---\n\nSource: Unknown source\nDocument type: text\nProduct ID: N/A\nCategory: N/A\nContent:\n"
    )
    assert out[2] == out[4] == "No question was provided."
    assert out[3] == "The available knowledge does not contain enough information."


def test_sync_embeds_only_changes(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "chunk_id string, t string")
    new = spark.createDataFrame([("a", "1"), ("b", "22"), ("d", "4")], "chunk_id string, t string")
    index = old.select("chunk_id", F.lit("old").alias("embedding"))
    out = R.sync_index(index, old, new, lambda rows: rows.withColumn("embedding", F.lit("new")))
    assert {(r.chunk_id, r.embedding) for r in out.collect()} == {("a", "old"), ("b", "new"), ("d", "new")}


def test_few_texts_and_queries_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(R, "TEXT_BLOCK", 2)
    monkeypatch.setattr(R, "QUERY_BLOCK", 2)
    rows = spark.createDataFrame([(i, f"w{i} w{i % 3} all") for i in range(9)] + [(9, None), (10, "")], "id int, t string").coalesce(1)
    embedder = R.HashedEmbedder(16).fit(rows, "t")
    found = {r.id: r.embedding for r in embedder.embed(rows, "t").collect()}
    assert {len(v) for v in found.values()} == {16} and not any(found[9]) and not any(found[10])
    slots = {r.id: r.s for r in rows.select("id", embedder.slots(R.F.coalesce("t", R.F.lit(""))).alias("s")).collect()}
    for i, at in slots.items():
        raw = np.bincount(at, minlength=16) * embedder.weights
        assert np.allclose(found[i], raw / (np.linalg.norm(raw) or 1))
    asked = rows.where("id < 5").select(R.F.col("id").alias("q"), "t")
    best = R.vector_topk(embedder.embed(asked, "t"), embedder.embed(rows, "t"), 1, "q", "id").collect()
    assert {r.q for r in best} == set(range(5)) and all(abs(r.score - 1) < 1e-6 for r in best)
