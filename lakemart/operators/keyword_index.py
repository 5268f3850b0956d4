"""A stored keyword index, and BM25 top-k that reads only the blocks it must.

Documents are dealt into ranges of about ``range_docs`` by the hash of their id.  The
postings of one term in one range are a block, filed by term hash, with the highest
weight any of its documents has.  A question's bound for a range is the sum of its
terms' highest weights there: no document of the range can score more.

A search sums the bounds from the blocks' heads alone, reads the few ranges with the
highest ones, and takes the k-th score found so far as threshold.  Of the other ranges
it reads only those whose bound reaches it.  Results are those of the full scan.
Questions go to the tasks in slices of about ``MAX_QUERIES``; what moves is each asked
term's blocks, once, and one line per question and range, never one per asked term.

A NULL text is no document.  A question without a known term has no result.  Equal
scores rank by id.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakemart.functions.text import terms
from lakemart.operators.retrieval import BM25_B, BM25_K1, MAX_QUERIES, SCORE_CELLS, SCORE_DIGITS, _select, keep_top, term_counts
from lakemart.sources.tables import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTS = 16
RANGE_DOCS = 128
FIRST_RANGES = 2  # read before there is a threshold


def _part(term: str = "term") -> Column:
    return F.pmod(F.xxhash64(term), F.lit(PARTS)).cast("int").alias("part")


@dataclass(frozen=True)
class KeywordIndex:
    """Blocks, document frequencies and totals in one folder."""

    path: str
    doc_id: str = "chunk_id"

    def write(self, docs: DataFrame, text: str = "chunk_to_retrieve", range_docs: int = RANGE_DOCS) -> KeywordIndex:
        """File all documents.  The totals are written last: without them there is no index."""
        texts = docs.where(F.col(text).isNotNull())
        totals = texts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size(terms(F.col(text)))), F.lit(0)).alias("words")).head()
        ranges = max(1, -(-totals.n // range_docs))
        average = totals.words / totals.n if totals.n else 0.0
        damping = BM25_K1 * (1 - BM25_B + BM25_B * F.col("length") / F.lit(average)) if average else F.lit(1.0)
        weight = F.col("tf") * (BM25_K1 + 1) / (F.col("tf") + damping)
        posting = F.struct(F.col(self.doc_id).alias("id"), weight.alias("weight"))
        # Texts are shuffled once, by range; their postings never are.
        place = F.pmod(F.xxhash64(self.doc_id), F.lit(ranges)).cast("int").alias("range")
        blocks = (
            term_counts(texts, self.doc_id, text, place)
            .groupBy(_part(), "term", "range")
            .agg(F.max(weight).alias("top"), F.collect_list(posting).alias("postings"))
        )
        laid = blocks.sortWithinPartitions("part", "term", "range")
        laid.write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/blocks")
        spark = docs.sparkSession
        # The folder names carry no type, and an empty index has no file that tells the rest.
        spark.createDataFrame([(blocks.schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/schema")
        counted = self.blocks(spark).groupBy("part", "term").agg(F.sum(F.size("postings")).alias("df"))
        counted.write.mode("overwrite").parquet(f"{self.path}/terms")
        spark.createDataFrame([(totals.n, totals.words, ranges)], "n long, words long, ranges int").coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/totals"
        )
        return self

    def blocks(self, spark: SparkSession) -> DataFrame:
        schema = StructType.fromJson(json.loads(spark.read.parquet(f"{self.path}/schema").head().schema))
        return spark.read.schema(schema).parquet(f"{self.path}/blocks")

    def topk(self, questions: DataFrame, k: int = 10, question_id: str = "question_id", question: str = "question") -> DataFrame:
        """(question, document, score, rank) of the ``k`` best documents of every question."""
        if question_id == self.doc_id:
            raise ValueError("question and document ids need different names")
        asked, plan, found = self._first(questions, k, question_id, question)
        rest = plan.where(F.col("read") & ~F.col("first")).select(question_id, "range")
        return keep_top(found.unionByName(self._scored(rest, asked, k, question_id)), k, question_id, self.doc_id)

    def reads(self, questions: DataFrame, k: int = 10, question_id: str = "question_id", question: str = "question") -> DataFrame:
        """(question, range, bound, first, read): what a search looks at, and what it skips."""
        return self._first(questions, k, question_id, question)[1]

    def _first(self, questions: DataFrame, k: int, question_id: str, question: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The asked terms, the plan for all ranges, and the results of the first ones."""
        spark = questions.sparkSession
        n = spark.read.parquet(f"{self.path}/totals").head().n
        rarity = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
        words = questions.select(question_id, F.explode(F.array_distinct(terms(F.col(question)))).alias("term")).distinct()
        known = spark.read.parquet(f"{self.path}/terms")
        asked = materialize(words.withColumn("part", _part()).join(known, ["part", "term"]).select(question_id, "part", "term", rarity.alias("rarity")), "asked-terms")
        heads = self.blocks(spark).select("part", "term", "range", "top")
        bound = F.sum(F.col("rarity") * F.col("top")).alias("bound")
        # Heads move once, to the task of their range; the lines of all questions that share a term arise there.
        bounds = _stacked(
            _of_asked(heads, some).repartition("range").join(F.broadcast(some), ["part", "term"]).groupBy(question_id, "range").agg(bound)
            for some in _slices(asked, question_id)
        )
        bounds = materialize(bounds, "range-bounds")
        best = keep_top(bounds.withColumn("score", F.col("bound")), FIRST_RANGES, question_id, "range").select(question_id, "range")
        best = materialize(best, "first-ranges")
        found = materialize(self._scored(best, asked, k, question_id), "first-found")
        limit = keep_top(found, k, question_id, self.doc_id).where(F.col("rank") == k).select(question_id, F.col("score").alias("limit"))
        # Scores are rounded, so a bound within a unit of the limit may still tie with it.
        reaches = F.col("limit").isNull() | (F.col("bound") + 10.0**-SCORE_DIGITS >= F.col("limit"))
        plan = bounds.join(best.withColumn("first", F.lit(True)), [question_id, "range"], "left").join(limit, question_id, "left")
        first = F.coalesce("first", F.lit(False))
        return asked, plan.select(question_id, "range", "bound", first.alias("first"), (first | reaches).alias("read")), found

    def _scored(self, pairs: DataFrame, asked: DataFrame, k: int, question_id: str) -> DataFrame:
        """Each question's ``k`` best documents in each of its ranges.

        A range and a slice of the questions meet in one task: a range has a bounded
        number of documents, a slice a bounded number of questions.
        """
        pairs = materialize(pairs, "asked-ranges")
        return _stacked(self._scored_slice(pairs, some, k, question_id) for some in _slices(asked, question_id))

    def _scored_slice(self, pairs: DataFrame, some: DataFrame, k: int, question_id: str) -> DataFrame:
        spark = pairs.sparkSession
        mine = pairs.join(F.broadcast(some.select(question_id).distinct()), question_id, "left_semi")
        blocks = self.blocks(spark)
        read = _of_asked(blocks, some).join(mine.select("range").distinct(), "range", "left_semi").select("range", "term", "postings")
        doc_type = blocks.schema["postings"].dataType.elementType["id"].dataType
        schema = StructType([some.schema[question_id], StructField(self.doc_id, doc_type), StructField("score", DoubleType())])
        names = schema.names
        asks = some.toArrow()  # the terms of one slice
        sent = spark.sparkContext.broadcast((asks.column(question_id).combine_chunks(), asks.column("term").combine_chunks(), asks.column("rarity").to_numpy()))

        def score(left: pa.Table, right: pa.Table) -> pa.Table:
            postings = right.column("postings").combine_chunks() if right.num_rows else None
            ids, kind = (postings.flatten().field("id"), left.schema.field(question_id).type) if right.num_rows and left.num_rows else (None, None)
            if ids is None:
                return pa.table({n: pa.array([], t) for n, t in zip(names, (left.schema.field(question_id).type, _id_type(right), pa.float64()))})
            docs = pc.unique(ids)
            weights = np.zeros((right.num_rows, len(docs)))
            weights[pc.list_parent_indices(postings).to_numpy(), pc.index_in(ids, docs).to_numpy()] = postings.flatten().field("weight").to_numpy()
            asking, terms_asked, rarity = sent.value
            questions = pc.unique(left.column(question_id).combine_chunks())
            who, what = pc.index_in(asking, questions), pc.index_in(terms_asked, right.column("term").combine_chunks())
            hit = pc.and_(pc.is_valid(who), pc.is_valid(what))
            who, what, rarity = who.filter(hit).to_numpy(), what.filter(hit).to_numpy(), rarity[hit.to_numpy(zero_copy_only=False)]
            doc_ids, question_ids, parts = np.asarray(docs.to_pylist()), np.asarray(questions.to_pylist()), []
            step = max(1, SCORE_CELLS // max(len(docs), len(weights)))
            for low in range(0, len(question_ids), step):
                mine = (who >= low) & (who < low + step)
                wanted = np.zeros((min(step, len(question_ids) - low), len(weights)))
                wanted[who[mine] - low, what[mine]] = rarity[mine]
                scores = wanted @ weights
                parts.append(_select(np.where(scores > 0, np.round(scores, SCORE_DIGITS), -np.inf), question_ids[low : low + step], doc_ids, k))
            found = [np.concatenate(p) for p in zip(*parts)]
            return pa.table({n: pa.array(c, t) for n, c, t in zip(names, found, (kind, ids.type, pa.float64()))})

        return mine.groupBy("range").cogroup(read.groupBy("range")).applyInArrow(score, schema)


def _slices(asked: DataFrame, question_id: str) -> list[DataFrame]:
    """The asked terms of about ``MAX_QUERIES`` questions at a time."""
    number = max(1, -(-asked.select(question_id).distinct().count() // MAX_QUERIES))
    return [asked.where(F.pmod(F.xxhash64(question_id), F.lit(number)) == i) for i in range(number)]


def _of_asked(blocks: DataFrame, some: DataFrame) -> DataFrame:
    """Blocks of the terms that a slice of the questions asks."""
    return blocks.join(F.broadcast(some.select("part", "term").distinct()), ["part", "term"], "left_semi")


def _stacked(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _id_type(table: pa.Table) -> pa.DataType:
    return table.schema.field("postings").type.value_type.field("id").type
