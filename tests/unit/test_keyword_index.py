import random

import pytest
from pyspark.sql import functions as F

from lakemart.operators import keyword_index as K
from lakemart.operators import retrieval as R

rnd = random.Random(3)
COMMON = [f"c{i}" for i in range(12)]


def make_docs():
    docs = {}
    for i in range(600):
        words = rnd.choices(COMMON, k=rnd.randrange(1, 25))
        words += [f"rare{i % 60}"] * rnd.randrange(3)
        docs[f"d{i}"] = " ".join(words)
    docs |= {f"copy{i}": "c1 c2 hot hot" for i in range(300)}  # a third of all rows
    return docs | {"empty": "", "null": None}


DOCS = make_docs()
ASKED = {1: "rare7 c1", 2: "hot", 3: "c0 c1 c2 c3 c3", 4: "no such word", 5: " ", 6: None, 7: "rare1 rare2 rare59 hot c9"}


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(list(DOCS.items()), "chunk_id string, chunk_to_retrieve string").repartition(4)
    asked = spark.createDataFrame(list(ASKED.items()), "question_id int, question string")
    return asked, docs


@pytest.fixture(scope="module")
def index(tables, tmp_path_factory):
    return K.KeywordIndex(str(tmp_path_factory.mktemp("index"))).write(tables[1], range_docs=8)


def found(df):
    return {(r.question_id, r.chunk_id, round(r.score, 6), r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("k", [1, 5, 40, 2000])
def test_same_rows_as_the_scan(tables, index, k):
    assert found(index.topk(tables[0], k)) == found(R.bm25_topk(*tables, k))


def test_questions_in_blocks(tables, index, monkeypatch):
    monkeypatch.setattr(K, "MAX_QUERIES", 2)
    monkeypatch.setattr(K, "SCORE_CELLS", 1)
    assert found(index.topk(tables[0], 7)) == found(R.bm25_topk(*tables, 7))


def test_blocks_below_the_limit_are_skipped(tables, index):
    plan = index.reads(tables[0], 3).collect()
    by_question = {q: [r for r in plan if r.question_id == q] for q in (1, 3, 7)}
    for q in (1, 7):  # a rare term decides: most ranges hold only the frequent ones
        skipped = [r for r in by_question[q] if not r.read]
        assert len(skipped) > 0.5 * len(by_question[q])
        assert min(r.bound for r in by_question[q] if r.read) >= max(r.bound for r in skipped) - 1e-6
    assert all(sum(r.first for r in rows) == K.FIRST_RANGES for rows in by_question.values())


def test_bounds_hold(tables, index):
    """No document scores more than its range's bound."""
    ranges = len(DOCS) // 8 + 1
    place = F.pmod(F.xxhash64("chunk_id"), F.lit(max(1, -(-(len(DOCS) - 1) // 8)))).cast("int")
    every = R.bm25_topk(*tables, 2000).withColumn("range", place)
    over = every.join(index.reads(tables[0], 2000), ["question_id", "range"]).where("score > bound + 1e-6")
    assert ranges > 50 and over.count() == 0


def test_blocks_are_filed_by_term_hash(spark, index):
    blocks = index.blocks(spark)
    assert blocks.where(F.col("part") != K._part()).count() == 0
    assert blocks.groupBy("term", "range").count().where("count > 1").count() == 0
    assert blocks.where(F.abs(F.col("top") - F.array_max("postings.weight")) > 1e-12).count() == 0
    # A term of a third of all documents is cut into many blocks of bounded size.
    assert blocks.where("term = 'hot'").agg(F.max(F.size("postings"))).head()[0] < 30


def test_no_documents_and_no_questions(tables, tmp_path):
    asked, docs = tables
    empty = K.KeywordIndex(str(tmp_path / "none")).write(docs.limit(0))
    assert empty.topk(asked).count() == 0
    some = K.KeywordIndex(str(tmp_path / "some")).write(docs.where("chunk_id = 'empty'"))
    assert some.topk(asked).count() == 0
    with pytest.raises(ValueError):
        some.topk(asked.withColumnRenamed("question_id", "chunk_id"), question_id="chunk_id")


def test_no_index_without_totals(tables, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        K.KeywordIndex(str(tmp_path / "unwritten")).topk(tables[0])


def test_one_shuffle_lays_out_all_postings(tables):
    place = F.pmod(F.xxhash64("chunk_id"), F.lit(5)).cast("int").alias("range")
    counts = R.term_counts(tables[1], "chunk_id", "chunk_to_retrieve", place)
    blocks = counts.groupBy(K._part(), "term", "range").agg(F.collect_list(F.struct("chunk_id", "tf")).alias("postings"))
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
