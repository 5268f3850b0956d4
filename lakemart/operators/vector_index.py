"""Approximate vector search that scores only the rows filed near a question.

Every hash table has a few fixed hyperplanes; the signs of a vector's products with
them make its code.  A row is filed under its code in each table.  A question asks
for its own code and for the neighbours that differ in one of the signs it was
closest to changing.  Rows and questions meet by (table, code); a code with many
rows or questions is cut into blocks, and each pair of blocks is one task's work.

Vectors that have no near neighbour share codes with many rows.  So every vector also
carries a sketch, the signs of further planes: of the rows met, only those whose
sketch differs from the question's in at most ``farthest`` signs are scored.

Signs are exact: components become whole numbers (units of 1 / SCALE) and planes are
whole numbers that follow from a digest of their place, so any engine can derive them.

Rows and questions without a vector are left out.  A vector of zeros has score 0 with
all others.  Equal scores rank by id.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakemart.operators.retrieval import BLOCK_ROWS, _matrix, _select, _unit, keep_top
from lakemart.sources.tables import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1 << 16
QUERY_BLOCK = 512
SCORE_DIGITS = 6
SHELF_BITS = 3  # of a code: rows are filed in folders by them


@lru_cache(maxsize=16)
def planes(count: int, dimensions: int, name: str) -> np.ndarray:
    """(count, dimensions) whole numbers from -2^15 to 2^15 - 1."""

    def number(plane: int, dimension: int) -> int:
        return int(hashlib.md5(f"{name}:{plane}:{dimension}".encode()).hexdigest()[:4], 16) - (1 << 15)

    return np.array([[number(b, d) for d in range(dimensions)] for b in range(count)], dtype=np.int64)


def products(vectors: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """(rows, planes) exact products of whole-number vectors and planes."""
    whole = np.floor(vectors * SCALE)
    # Doubles are exact up to 2^53, and their products much faster.
    exact = np.float64 if np.abs(whole).max(initial=0) * (1 << 15) * whole.shape[1] < 1 << 53 else np.int64
    return whole.astype(exact) @ normals.T.astype(exact)


def sketches(vectors: np.ndarray, bits: int) -> np.ndarray:
    """(rows, bits / 64) signs of the further planes, packed."""
    signs = products(vectors, planes(bits, vectors.shape[1], "sketch")) >= 0
    return np.packbits(signs, axis=1, bitorder="little").view(np.uint64)


def within(asked: np.ndarray, held: np.ndarray, farthest: int) -> np.ndarray:
    """(questions, rows): do their sketches differ in at most ``farthest`` signs?"""
    apart = np.zeros((len(asked), len(held)), dtype=np.uint16)
    for word in range(asked.shape[1]):
        apart += np.bitwise_count(asked[:, word, None] ^ held[None, :, word])
    return apart <= farthest


def _sketch(table: pa.Table) -> np.ndarray:
    column = table.column("sketch").combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1).view(np.uint64)


@dataclass(frozen=True)
class SignIndex:
    """Parameters of the index; the same ones file the rows and ask for them."""

    tables: int = 10
    bits: int = 5
    probes: int = 3  # neighbours asked for in each table
    sketch_bits: int = 512  # a multiple of 64
    farthest: int = 232  # signs
    block_rows: int = BLOCK_ROWS
    query_block: int = QUERY_BLOCK

    def __post_init__(self):
        if not 0 <= self.probes <= self.bits or self.sketch_bits % 64:
            raise ValueError("probes must lie between 0 and bits, and sketches have a multiple of 64 bits")

    def filed(self, corpus: DataFrame, corpus_id: str = "chunk_id", vector: str = "embedding") -> DataFrame:
        """(hash_table, shelf, code, id, vector, sketch), one row per vector and table."""
        return self._placed(corpus, corpus_id, vector, 0)

    def write(self, corpus: DataFrame, path: str, corpus_id: str = "chunk_id", vector: str = "embedding") -> DataFrame:
        """File the rows in folders by table and shelf, and read them back."""
        rows = self.filed(corpus, corpus_id, vector)
        laid = rows.repartitionByRange("hash_table", "code", F.xxhash64(corpus_id)).sortWithinPartitions("hash_table", "shelf", "code")
        laid.write.mode("overwrite").partitionBy("hash_table", "shelf").parquet(path)
        return self.read(corpus.sparkSession, path)

    @staticmethod
    def read(spark: SparkSession, path: str) -> DataFrame:
        return spark.read.parquet(path)

    def topk(
        self, queries: DataFrame, filed: DataFrame, k: int = 10, query_id: str = "question_id", corpus_id: str = "chunk_id", vector: str = "embedding"
    ) -> DataFrame:
        """Cosine top-k of every question among the rows its codes lead to.

        ``filed`` is read from folders: only those that some question names are
        opened.  ``score`` is rounded to six places before ranking.
        """
        if query_id == corpus_id:
            raise ValueError("query_id and corpus_id must differ")
        schema = StructType([queries.schema[query_id], filed.schema[corpus_id], StructField("score", DoubleType())])
        farthest = self.farthest
        rows, asked = self._cells(queries, filed, query_id, corpus_id, vector)
        key = ["hash_table", "code", "_rows", "_queries"]

        def score(queries: pa.Table, rows: pa.Table) -> pa.Table:
            kinds = {f.name: f.type for f in (queries.schema.field(query_id), rows.schema.field(corpus_id))} | {"score": pa.float64()}
            if not queries.num_rows or not rows.num_rows:
                return pa.table({n: pa.array([], t) for n, t in kinds.items()})
            near = within(_sketch(queries), _sketch(rows), farthest)
            left, right = _unit(_matrix(queries.column(vector))), _unit(_matrix(rows.column(vector)))
            scores = np.full(near.shape, -np.inf)
            for at in range(len(left)):  # only the pairs that are left
                held = np.flatnonzero(near[at])
                scores[at, held] = np.round(right[held] @ left[at], SCORE_DIGITS) + 0.0
            ids = np.asarray(rows.column(corpus_id).to_pylist())
            found = _select(scores, np.asarray(queries.column(query_id).to_pylist()), ids, k)
            return pa.table({n: pa.array(c, t) for (n, t), c in zip(kinds.items(), found)})

        scored = asked.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(score, schema)
        # A pair may meet in several tables, with one score.
        return keep_top(scored.dropDuplicates([query_id, corpus_id]), k, query_id, corpus_id)

    def met(self, queries: DataFrame, filed: DataFrame, query_id: str = "question_id", corpus_id: str = "chunk_id", vector: str = "embedding") -> DataFrame:
        """(question, row, scored): the pairs that meet, and whether their sketches let :meth:`topk` score them."""
        asked = self._placed(queries, query_id, vector, self.probes).select("hash_table", "code", query_id, F.col("sketch").alias("_asked"))
        pairs = filed.select("hash_table", "code", corpus_id, "sketch").join(asked, ["hash_table", "code"]).dropDuplicates([query_id, corpus_id])
        apart = F.aggregate(F.zip_with("sketch", "_asked", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, x: n + x)
        return pairs.select(query_id, corpus_id, (apart <= self.farthest).alias("scored"))

    def _placed(self, df: DataFrame, key: str, vector: str, probes: int) -> DataFrame:
        """Rows under their codes and, with ``probes``, under the neighbours nearest to them."""
        tables, bits = self.tables, self.bits
        sketch_bits = self.sketch_bits

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                vectors = _matrix(batch.column(1))
                found = products(vectors, planes(tables * bits, vectors.shape[1], "code")).reshape(-1, tables, bits)
                closest = np.argsort(np.abs(found), axis=2, kind="stable")[:, :, :probes]
                own = ((found >= 0) << np.arange(bits)).sum(axis=2)
                words = sketches(vectors, sketch_bits).view(np.int64)
                sketch = pa.FixedSizeListArray.from_arrays(pa.array(words.ravel()), words.shape[1]).cast(pa.list_(pa.int64()))
                asked = np.concatenate([own[:, :, None], own[:, :, None] ^ (1 << closest)], axis=2)
                table = np.broadcast_to(np.arange(tables)[None, :, None], asked.shape)
                owner = pa.array(np.repeat(np.arange(batch.num_rows), tables * (1 + probes)))
                flat = asked.ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(table.ravel(), pa.int32()), pa.array(flat >> max(0, bits - SHELF_BITS), pa.int32()), pa.array(flat, pa.int64()),
                        batch.column(0).take(owner), batch.column(1).take(owner), sketch.take(owner),
                    ],
                    names=["hash_table", "shelf", "code", key, vector, "sketch"],
                )

        known = df.filter(F.col(vector).isNotNull()).select(key, vector)
        kinds = {f.name: f.dataType.simpleString() for f in known.schema}
        return known.mapInArrow(place, f"hash_table int, shelf int, code long, `{key}` {kinds[key]}, `{vector}` {kinds[vector]}, sketch array<long>")

    def _cells(self, queries: DataFrame, filed: DataFrame, query_id: str, corpus_id: str, vector: str) -> tuple[DataFrame, DataFrame]:
        """Rows and questions dealt to cells of at most about ``block_rows`` x ``query_block``."""
        place = ["hash_table", "shelf", "code"]
        asked = materialize(self._placed(queries, query_id, vector, self.probes), "asked-codes")
        wanted = asked.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / self.query_block).cast("int").alias("query_blocks"))
        held = filed.join(wanted, place).groupBy(*place, "query_blocks")
        # One row per code that is both asked for and filed under: at most 2^bits per table.
        cut = materialize(held.agg(F.ceil(F.count(F.lit(1)) / self.block_rows).cast("int").alias("row_blocks")), "asked-blocks")

        def dealt(df: DataFrame, key: str, own: str, own_blocks: str, other: str, other_blocks: str) -> DataFrame:
            block = F.pmod(F.xxhash64(key), F.col(own_blocks)).cast("int")
            every = F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1))
            joined = df.join(cut, place).withColumn(own, block).withColumn(other, every)
            return joined.select("hash_table", "code", "_rows", "_queries", key, vector, "sketch")

        return dealt(filed, corpus_id, "_rows", "row_blocks", "_queries", "query_blocks"), dealt(asked, query_id, "_queries", "query_blocks", "_rows", "row_blocks")
