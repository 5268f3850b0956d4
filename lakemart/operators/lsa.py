"""A learned embedding: latent semantic analysis by randomised subspace iteration.

The term matrix has one row per text, its hashed terms weighted by rarity, at unit
length.  Its strongest directions are found by multiplying a random block of
directions with the matrix and its transpose a few times.  Tasks hold the block and a
batch of rows; what comes back is one number per slot and direction, a size set by the
parameters.  Only matrices of that size are factored on the driver.

Directions have fixed signs: the largest component is positive.  NULL and empty texts
get a vector of zeros.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators.retrieval import HashedEmbedder, _unit
from lakemart.sources.tables import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH = 1024  # rows of the term matrix that are spelled out at a time


def term_matrix(lists: pa.ListArray, weights: np.ndarray) -> np.ndarray:
    """Rows of weighted term counts, at unit length."""
    owner = np.asarray(pa.compute.list_parent_indices(lists), dtype=np.int64)
    slot = np.asarray(lists.flatten(), dtype=np.int64)
    width = len(weights)
    counts = np.bincount(owner * width + slot, minlength=len(lists) * width)
    return _unit(counts.reshape(len(lists), width) * weights)


class LatentEmbedder:
    """Texts as vectors of ``k`` numbers along the strongest directions of a corpus."""

    def __init__(self, k: int = 64, slots: int = 2048, extra: int = 16, passes: int = 3, seed: int = 7):
        if k + extra > slots:
            raise ValueError("more directions than slots")
        self.k, self.extra, self.passes, self.seed = k, extra, passes, seed
        self.hashed = HashedEmbedder(slots)
        self.directions: np.ndarray | None = None  # slots x k
        self.strengths: np.ndarray | None = None  # singular values

    def fit(self, corpus: DataFrame, text: str) -> LatentEmbedder:
        """Reads the corpus ``passes`` + 2 times, as written lists of slots."""
        rows = materialize(corpus.select(self.hashed.slots(F.coalesce(F.col(text), F.lit(""))).alias("slots")), "lsa-slots")
        self.hashed.fit_slots(rows)
        block = np.random.default_rng(self.seed).normal(size=(self.hashed.dimensions, self.k + self.extra))
        block = np.linalg.qr(block)[0]
        for _ in range(self.passes):
            block = np.linalg.qr(self._twice(rows, block))[0]
        inner = block.T @ self._twice(rows, block)  # how the matrix acts within the block
        squares, turns = np.linalg.eigh((inner + inner.T) / 2)
        best = np.argsort(-squares, kind="stable")[: self.k]
        found = block @ turns[:, best]
        signs = np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])
        self.directions = found * np.where(signs == 0, 1, signs)
        self.strengths = np.sqrt(np.maximum(squares[best], 0))
        return self

    def _twice(self, rows: DataFrame, block: np.ndarray) -> np.ndarray:
        """The block multiplied with the term matrix and then with its transpose."""
        sent = rows.sparkSession.sparkContext.broadcast((self.hashed.weights, block))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, block = sent.value
            total = np.zeros_like(block)
            for batch in batches:
                for at in range(0, batch.num_rows, BATCH):
                    matrix = term_matrix(batch.column(0).slice(at, BATCH), weights)
                    total += matrix.T @ (matrix @ block)
            used = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(list(total[used]), pa.list_(pa.float64()))], names=["slot", "row"]
            )

        parts = rows.mapInArrow(run, "slot int, row array<double>")
        sums = F.array(*(F.sum(F.col("row")[j]) for j in range(block.shape[1])))
        out = np.zeros_like(block)
        for line in parts.groupBy("slot").agg(sums.alias("row")).collect():  # at most one row per slot
            out[line.slot] = line.row
        return out

    def embed(self, df: DataFrame, text: str, name: str = "embedding") -> DataFrame:
        """Add the vector of every text, at unit length."""
        if self.directions is None:
            raise ValueError("fit the embedder first")
        weights, directions = self.hashed.weights, self.directions

        @F.arrow_udf("array<double>")
        def vectors(slots: pa.Array) -> pa.Array:
            parts = []
            for at in range(0, len(slots), BATCH):
                found = _unit(term_matrix(slots.slice(at, BATCH), weights) @ directions)
                ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1])
                parts.append(pa.ListArray.from_arrays(ends, found.ravel()))
            return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float64()))

        return df.withColumn(name, vectors(self.hashed.slots(F.coalesce(F.col(text), F.lit("")))))
