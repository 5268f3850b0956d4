"""Top-k search over a chunk table: vectors, keywords, and both fused.

All searches answer a whole table of questions.  Keyword search sends slices of
about ``MAX_QUERIES`` questions to every task, however many there are; vector
search sends up to that many at once and cuts both tables into blocks beyond.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakemart.functions.text import terms
from lakemart.operators.cdc import table_diff
from lakemart.sources.tables import materialize

# Tasks receive the helpers below with the job itself, so executors need no
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_QUERIES = 2048
BLOCK_ROWS = 8192
TEXT_BLOCK = 1024
QUERY_BLOCK = 64
SCORE_CELLS = 4 << 20  # scores a task holds at a time
SCORE_DIGITS = 6

# Constants of the BM25 and rank fusion formulas.
BM25_K1, BM25_B = 1.2, 0.75
RRF_CONSTANT = 60


def keep_top(scored: DataFrame, k: int, group: str, item: str) -> DataFrame:
    """Best ``k`` items per group with their rank; equal scores go by item.

    Spark limits each group in front of the shuffle, so every task sends at
    most ``k`` rows per group.
    """
    best = Window.partitionBy(group).orderBy(F.col("score").desc(), F.col(item))
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


# -------------------------------------------------------------------- vectors


def _unit(matrix: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norm, out=np.zeros_like(matrix), where=norm > 0)


def _first_k(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row, positions of the ``k`` largest scores; the leftmost of equals."""
    n = scores.shape[1]
    if n <= k:
        return np.tile(np.arange(n), (scores.shape[0], 1))
    limit = np.partition(scores, n - k, axis=1)[:, n - k, None]
    above = scores > limit
    equal = scores == limit
    room = k - above.sum(axis=1, keepdims=True)
    chosen = above | (equal & (np.cumsum(equal, axis=1) <= room))
    return np.nonzero(chosen)[1].reshape(scores.shape[0], k)


def _best_of_block(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's ``k`` best rows of one block."""
    columns, parts = _unit(vectors).T, []
    # Ranking makes several copies of the scores: some queries at a time.
    for at in range(0, max(1, len(queries)), QUERY_BLOCK):
        scores = np.round(queries[at : at + QUERY_BLOCK] @ columns, SCORE_DIGITS) + 0.0  # no -0.0
        parts.append(_select(scores, query_ids[at : at + QUERY_BLOCK], ids, k))
    owners, found, values = (np.concatenate(p) for p in zip(*parts))
    return owners, found, values


def _select(
    scores: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best ``k`` columns per row of ``scores``, equal scores by id."""
    order = np.argsort(ids, kind="stable")
    ids, scores = ids[order], scores[:, order]
    at = _first_k(scores, k)
    picked = np.take_along_axis(scores, at, axis=1)
    real = picked > -np.inf
    owner = np.repeat(query_ids, at.shape[1]).reshape(at.shape)
    return owner[real], ids[at][real], picked[real]


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def _result_schema(queries: DataFrame, query_id: str, corpus: DataFrame, corpus_id: str) -> StructType:
    return StructType(
        [
            StructField(query_id, queries.schema[query_id].dataType),
            StructField(corpus_id, corpus.schema[corpus_id].dataType),
            StructField("score", DoubleType()),
        ]
    )


def vector_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 10,
    query_id: str = "question_id",
    corpus_id: str = "chunk_id",
    vector: str = "embedding",
    max_queries: int = MAX_QUERIES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact cosine top-k, one matrix product per Arrow batch of the corpus.

    A task keeps only each query's best ``k`` of a batch, so no table of all
    pairs ever exists.  ``score`` is rounded to six places before ranking, and
    equal scores rank by id.

    With more than ``max_queries`` queries, both tables are cut into blocks of
    bounded size, and each pair of blocks is one task's work.
    """
    if query_id == corpus_id:
        raise ValueError("query_id and corpus_id must differ")
    asked = queries.filter(F.col(vector).isNotNull()).select(query_id, vector)
    stored = corpus.filter(F.col(vector).isNotNull()).select(corpus_id, vector)
    schema = _result_schema(asked, query_id, stored, corpus_id)

    head = asked.limit(max_queries + 1).toArrow()
    if head.num_rows > max_queries:
        scored = _by_blocks(asked, stored, k, query_id, corpus_id, vector, block_rows, schema)
        return keep_top(scored, k, query_id, corpus_id)
    if head.num_rows == 0:
        return keep_top(asked.sparkSession.createDataFrame([], schema), k, query_id, corpus_id)

    question_ids = np.asarray(head.column(query_id).to_pylist())
    question_vectors = _unit(_matrix(head.column(vector)))
    sent = asked.sparkSession.sparkContext.broadcast((question_ids, question_vectors))
    out = pa.schema([(f.name, _arrow_type(f)) for f in schema])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, qvectors = sent.value
        rows = max(k, SCORE_CELLS // len(qids))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                found = _best_of_block(qvectors, qids, _matrix(part.column(1)), np.asarray(part.column(0).to_pylist()), k)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, out)], schema=out)

    return keep_top(stored.mapInArrow(score, schema), k, query_id, corpus_id)


def _arrow_type(field: StructField) -> pa.DataType:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    return kinds[field.dataType.simpleString()]


def _by_blocks(asked, stored, k, query_id, corpus_id, vector, block_rows, schema) -> DataFrame:
    """Every block of queries against every block of the corpus."""
    parts = [max(1, -(-df.count() // block_rows)) for df in (asked, stored)]

    def blocks(df: DataFrame, id_column: str, mine: int) -> DataFrame:
        own = F.pmod(F.xxhash64(id_column), F.lit(parts[mine])).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(parts[1 - mine] - 1)))
        names = ("_q", "_c") if mine == 0 else ("_c", "_q")
        return df.withColumn(names[0], own).withColumn(names[1], every)

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({f.name: [] for f in schema})
        stack = lambda frame, name: np.stack(frame[name].to_numpy()).astype(np.float64)
        found = _best_of_block(_unit(stack(left, vector)), left[query_id].to_numpy(), stack(right, vector), right[corpus_id].to_numpy(), k)
        return pd.DataFrame(dict(zip((f.name for f in schema), found)))

    pairs = blocks(asked, query_id, 0).groupBy("_q", "_c").cogroup(blocks(stored, corpus_id, 1).groupBy("_q", "_c"))
    return pairs.applyInPandas(score, schema)


# ------------------------------------------------------------------ embedding


class HashedEmbedder:
    """Text to a dense vector: hashed term counts, weighted by rarity, unit length.

    A stand-in for a hosted embedding model with the same place in the job.
    ``fit`` reads the corpus once and keeps one number per dimension.
    """

    def __init__(self, dimensions: int = 256):
        self.dimensions = dimensions
        self.weights: np.ndarray | None = None

    def slots(self, text: Column) -> Column:
        """Dimension of every term; the hash is one other engines have too."""
        number = lambda t: F.conv(F.substring(F.md5(t.cast("binary")), 1, 8), 16, 10)
        return F.transform(terms(text), lambda t: (number(t).cast("bigint") % self.dimensions).cast("int"))

    def fit(self, corpus: DataFrame, text: str) -> HashedEmbedder:
        return self.fit_slots(corpus.select(self.slots(F.col(text)).alias("slots")))

    def fit_slots(self, rows: DataFrame) -> HashedEmbedder:
        """The same from the slots of every text, where they are at hand."""
        counted = (
            rows.select(F.explode(F.array_distinct("slots")).alias("slot"))
            .groupBy("slot")
            .count()
            .unionByName(rows.select(F.lit(-1).alias("slot")).groupBy("slot").count())
        )
        # At most one row per dimension, and the total.
        counts = {row.slot: row["count"] for row in counted.collect()}
        total = counts.pop(-1, 0)
        seen = np.array([counts.get(i, 0) for i in range(self.dimensions)], dtype=np.float64)
        self.weights = np.log((total + 1.0) / (seen + 1.0))
        return self

    def save(self, spark: SparkSession, path: str) -> None:
        """One small row: the weight of every dimension."""
        row = [(self.dimensions, [float(w) for w in self.weights])]
        spark.createDataFrame(row, "dimensions int, weights array<double>").coalesce(1).write.mode(
            "overwrite"
        ).parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> HashedEmbedder:
        row = spark.read.parquet(path).head()
        out = cls(row.dimensions)
        out.weights = np.array(row.weights)
        return out

    def embed(self, df: DataFrame, text: str, name: str = "embedding") -> DataFrame:
        if self.weights is None:
            raise ValueError("fit the embedder first")
        weights, dimensions = self.weights, self.dimensions

        # A batch has up to 10,000 texts: few of them are spelled out at a time.
        @F.arrow_udf("array<double>")
        def vectors(slots: pa.Array) -> pa.Array:
            parts = []
            for at in range(0, len(slots), TEXT_BLOCK):
                lists = slots.slice(at, TEXT_BLOCK)
                owner = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
                places = owner * dimensions + lists.flatten().to_numpy()
                counts = np.bincount(places, minlength=len(lists) * dimensions).reshape(len(lists), dimensions)
                ends = pa.array(np.arange(len(lists) + 1, dtype=np.int32) * dimensions)
                parts.append(pa.ListArray.from_arrays(ends, _unit(counts * weights).ravel()))
            return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float64()))

        return df.withColumn(name, vectors(self.slots(F.coalesce(F.col(text), F.lit("")))))


# ------------------------------------------------------------------- keywords


def term_counts(docs: DataFrame, doc_id: str, text: str, place: Column | None = None) -> DataFrame:
    """(doc_id, length, term, tf), laid out by document.

    Texts are shuffled once by their id; the counts, and later the scores per
    document, need no further shuffle of the postings.  With ``place``, a function
    of the id, they are laid out by it instead, and it comes along.
    """
    shown = [] if place is None else [place]
    placed = docs.select(*shown, doc_id, F.col(text).alias("_text"))
    first = placed.columns[: len(shown)]
    placed = placed.repartition(*(F.col(c) for c in first or [doc_id]))
    listed = placed.select(*first, doc_id, terms(F.col("_text")).alias("_terms"))
    return (
        listed.select(*first, doc_id, F.size("_terms").alias("length"), F.explode_outer("_terms").alias("term"))
        .filter("term IS NOT NULL")
        .groupBy(*first, doc_id, "length", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def bm25_topk(
    questions: DataFrame,
    docs: DataFrame,
    k: int = 10,
    question_id: str = "question_id",
    question: str = "question",
    doc_id: str = "chunk_id",
    text: str = "chunk_to_retrieve",
    slice_size: int = MAX_QUERIES,
) -> DataFrame:
    """BM25 keyword top-k of every question over the whole corpus.

    The corpus is scored where it lies, without a shuffle of texts or postings,
    and each batch passes on at most ``k`` rows per question.  The questions go
    in slices of about ``slice_size``, all scored alike.  A NULL text is no
    document: it counts neither in the number of documents nor in their length.
    """
    docs = docs.where(F.col(text).isNotNull())
    asked = questions.select(question_id, F.explode(F.array_distinct(terms(F.col(question)))).alias("term"))
    words = docs.select(doc_id, terms(F.col(text)).alias("_terms"))
    # One pass for the totals and the number of documents with each asked term.
    totals = Observation()
    seen = words.observe(totals, F.count(F.lit(1)).alias("n"), F.sum(F.size("_terms")).alias("words"))
    frequency = materialize(
        seen.select(F.explode(F.array_distinct("_terms")).alias("term"))
        .join(asked.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df")),
        "bm25-frequency",
    )
    n = totals.get["n"]
    average = (totals.get["words"] or 0) / n if n else 0.0
    schema = _result_schema(asked, question_id, docs, doc_id)
    slices = max(1, -(-asked.select(question_id).distinct().count() // slice_size))
    scored = [
        _bm25_slice(asked.where(F.pmod(F.xxhash64(question_id), F.lit(slices)) == i), words, frequency, n, average, k, question_id, schema)
        for i in range(slices)
    ]
    return keep_top(reduce(DataFrame.unionByName, scored), k, question_id, doc_id)


def _bm25_slice(asked, words, frequency, n, average, k, question_id, schema) -> DataFrame:
    """The best k documents of each batch for one slice of the questions."""
    spark = words.sparkSession
    pairs = asked.toArrow()  # the terms of one slice
    vocabulary = pc.unique(pairs.column("term")) if pairs.num_rows else pa.array([], pa.string())
    if len(vocabulary) == 0:
        return spark.createDataFrame([], schema)
    known = frequency.join(asked.select("term").distinct(), "term", "left_semi").toArrow()
    df = np.zeros(len(vocabulary))
    df[pc.index_in(known.column("term"), vocabulary).to_numpy()] = known.column("df").to_numpy()
    rarity = np.log(1 + (n - df + 0.5) / (df + 0.5))

    ids = np.asarray(pc.unique(pairs.column(question_id)).to_pylist())
    position = {q: i for i, q in enumerate(ids.tolist())}
    wants = np.array([position[q] for q in pairs.column(question_id).to_pylist()])
    term_of = pc.index_in(pairs.column("term"), vocabulary).to_numpy()
    sent = spark.sparkContext.broadcast((vocabulary, rarity, ids, term_of, wants, average))
    out = pa.schema([(f.name, _arrow_type(f)) for f in schema])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, rarity, ids, term_of, wants, average = sent.value
        # Texts x questions and texts x terms stay within SCORE_CELLS.
        block = max(1, min(TEXT_BLOCK, SCORE_CELLS // max(len(ids), len(vocabulary))))
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                scores = _bm25_scores(part.column(1), vocabulary, rarity, term_of, wants, len(ids), average)
                found = _select(scores, ids, np.asarray(part.column(0).to_pylist()), k)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, out)], schema=out)

    return words.mapInArrow(score, schema)


def _bm25_scores(lists: pa.ListArray, vocabulary, rarity, term_of, wants, n_questions, average) -> np.ndarray:
    """Questions x documents; minus infinity where no term is shared."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.float64)
    at = pc.index_in(lists.flatten(), vocabulary)
    hit = pc.is_valid(at).to_numpy(zero_copy_only=False)
    owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)[hit]
    term = at.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
    used, column = np.unique(term, return_inverse=True)
    tf = np.zeros((len(lists), len(used)))
    np.add.at(tf, (owner, column), 1.0)
    damped = tf + BM25_K1 * (1 - BM25_B + BM25_B * lengths / average)[:, None] if average else tf + 1.0
    weights = rarity[used] * tf * (BM25_K1 + 1) / damped
    asked = np.zeros((len(used), n_questions))
    slot = np.searchsorted(used, term_of)
    present = slot < len(used)
    present[present] = used[slot[present]] == term_of[present]
    asked[slot[present], wants[present]] = 1.0
    scores = (weights @ asked).T
    return np.where(scores > 0, np.round(scores, SCORE_DIGITS), -np.inf)


# --------------------------------------------------------------------- hybrid


def fuse(left: DataFrame, right: DataFrame, k: int, question_id: str, doc_id: str) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists per question."""
    votes = left.select(question_id, doc_id, "rank").unionByName(right.select(question_id, doc_id, "rank"))
    score = F.round(F.sum(1.0 / (RRF_CONSTANT + F.col("rank"))), 9)
    return keep_top(votes.groupBy(question_id, doc_id).agg(score.alias("score")), k, question_id, doc_id)


def hybrid_topk(
    questions: DataFrame,
    chunks: DataFrame,
    embedder: HashedEmbedder,
    k: int = 10,
    window: int = 50,
    question_id: str = "question_id",
    question: str = "question",
    doc_id: str = "chunk_id",
    text: str = "chunk_to_retrieve",
    embed_text: str = "chunk_to_embed",
) -> DataFrame:
    """Vector and keyword search fused over the best ``window`` of each."""
    by_vector = vector_topk(
        embedder.embed(questions, question), embedder.embed(chunks, embed_text), window, question_id, doc_id
    )
    by_words = bm25_topk(questions, chunks, window, question_id, question, doc_id, text)
    return fuse(by_vector, by_words, k, question_id, doc_id)


# -------------------------------------------------------------------- context

# What a reader of the context gets to see.
NO_QUESTION = "No question was provided."
NO_KNOWLEDGE = "The available knowledge does not contain enough information."
CONTEXT_LINES = (
    ("Source", "source_uri", "Unknown source"),
    ("Document type", "document_type", "Unknown"),
    ("Product ID", "product_id", "N/A"),
    ("Category", "category", "N/A"),
)
SEPARATOR = "\n\n---\n\n"
RETRIEVED = ("chunk_id", "chunk_to_retrieve", "document_type", "source_uri", "product_id", "category")


def retrieved_columns(hits: DataFrame, chunks: DataFrame, doc_id: str = "chunk_id") -> DataFrame:
    """Hits (few: ``k`` per question) with the chunk columns shown to a reader."""
    return chunks.select(*RETRIEVED).join(hits, doc_id)


def contexts(
    questions: DataFrame,
    hits: DataFrame,
    question_id: str = "question_id",
    question: str = "question",
) -> DataFrame:
    """One context text per question, its hits in rank order.

    Blank questions and questions without hits get a fixed sentence.  ``hits``
    holds at most ``k`` rows per question, so each list is short.
    """

    def shown(column: str, default: str) -> Column:
        value = F.coalesce(F.col(column), F.lit(""))
        return F.when(value == "", F.lit(default)).otherwise(value)

    block = F.concat(
        *(F.concat(F.lit(f"{label}: "), shown(c, default), F.lit("\n")) for label, c, default in CONTEXT_LINES),
        F.lit("Content:\n"),
        F.coalesce("chunk_to_retrieve", F.lit("")),
    )
    listed = hits.groupBy(question_id).agg(
        F.sort_array(F.collect_list(F.struct(F.col("rank"), block.alias("block")))).alias("_blocks")
    )
    text = F.array_join(F.transform("_blocks", lambda b: b.block), SEPARATOR)
    # Blank means nothing but white space of any kind.
    blank = ~F.coalesce(F.col(question), F.lit("")).rlike(r"\S")
    return questions.join(listed, question_id, "left").select(
        question_id,
        question,
        F.when(blank, F.lit(NO_QUESTION))
        .when(F.col("_blocks").isNull(), F.lit(NO_KNOWLEDGE))
        .otherwise(text)
        .alias("context"),
    )


# ---------------------------------------------------------------------- index


def sync_index(index: DataFrame, old_chunks: DataFrame, new_chunks: DataFrame, embed, key: str = "chunk_id") -> DataFrame:
    """The index after a triggered sync: only changed chunks are embedded again.

    ``index`` is (key, embedding) for ``old_chunks``; ``embed`` maps chunk rows
    to the same with an ``embedding`` column.
    """
    changes = table_diff(old_chunks, new_chunks, key)
    kept = index.join(changes.select(key), key, "left_anti")
    fresh = embed(changes.filter("change_type != 'delete'").drop("change_type"))
    return kept.unionByName(fresh.select(*kept.columns))
