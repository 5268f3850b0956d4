"""Centroid clustering in whole numbers, nearest centroids by Orchard's search.

Each centroid has a list of the others by their distance from it.  A search walks
the list of its current centroid, skips those it has visited, and jumps to the
list of any centroid that is closer to the vector.  It stops when the next one on
the list is strictly beyond twice the current distance: by the triangle
inequality none from there on can be as close.  Distances are squared whole
numbers, so that stop and ties (the smaller number wins) are exact.

Vectors lie in a written table; each round reads it, sums within tasks and brings
the sums of the K clusters, a fixed size, to the driver.

Vectors with another number of components, or a component that is NULL or not
finite, are left out, NULL vectors too.  Rows with equal ids are vectors of their
own; a NULL id comes last in the choice of the first centroids, equal hashes are
chosen by components.  With fewer vectors than K each is a first centroid; empty
table: no rows.  A component beyond LIMIT / FACTOR, whose squared distances pass 64
bits, is an error.  Further columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import ship, stored

DIMENSIONS = 64
K = 40
ROUNDS = 5
SALT = "2:"
FACTOR = 256
LIMIT = 1 << 27
BLOCK = 8192  # vectors searched at a time


@dataclass
class Centroids:
    """Centroids with the lists that a search walks."""

    points: np.ndarray  # (k, dimensions), whole numbers
    order: np.ndarray = field(init=False)
    quarter: np.ndarray = field(init=False)
    start: int = field(init=False)

    def __post_init__(self):
        gap = self.points[:, None, :] - self.points[None, :, :]
        between = (gap * gap).sum(axis=2)
        own = np.eye(len(between), dtype=bool)
        self.order = np.argsort(np.where(own, -1, between), axis=1, kind="stable")[:, 1:]
        # between > 4 * d is the same as (between - 1) // 4 >= d, without leaving 64 bits.
        self.quarter = (between - 1) // 4
        self.start = int(between.astype(np.float64).sum(axis=1).argmin())

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each vector."""
        parts = [self._search(vectors[low : low + BLOCK]) for low in range(0, len(vectors), BLOCK)]
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All searches of a block side by side, each at its own place."""
        n, k = len(vectors), len(self.points)
        best = np.full(n, self.start)
        gap = vectors - self.points[self.start]
        least = (gap * gap).sum(axis=1)
        visited = np.zeros((n, k), dtype=bool)
        visited[:, self.start] = True
        place = np.zeros(n, dtype=np.int64)
        live = np.arange(n)
        while True:
            live = live[place[live] < k - 1]
            following = self.order[best[live], place[live]]
            near = self.quarter[best[live], following] < least[live]
            live, following = live[near], following[near]
            if not len(live):
                return best, least
            place[live] += 1
            new = ~visited[live, following]
            who, tried = live[new], following[new]
            visited[who, tried] = True
            gap = vectors[who] - self.points[tried]
            distance = (gap * gap).sum(axis=1)
            closer = (distance < least[who]) | ((distance == least[who]) & (tried < best[who]))
            moved = who[closer]
            best[moved], least[moved], place[moved] = tried[closer], distance[closer], 0


def whole_vectors(vectors: DataFrame, vec_id: str, embedding: str, dimensions: int) -> DataFrame:
    """(vec_id, v) of the vectors that take part, components as whole numbers."""
    raw = F.col(embedding)
    usable = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    error = F.raise_error(F.lit(f"a component beyond {LIMIT // FACTOR}: squared distances would not fit into 64 bits")).cast("long")

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * FACTOR
        return F.when(F.abs(scaled) <= LIMIT, F.floor(scaled)).otherwise(error)

    kept = vectors.where(raw.isNotNull() & (F.size(raw) == dimensions) & usable)
    return kept.select(F.col(vec_id).alias("vec_id"), F.transform(raw, whole).alias("v"))


def block_of(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return np.asarray(batch.column("v").flatten(), dtype=np.int64).reshape(-1, dimensions)


def first_centroids(rows: DataFrame, k: int, salt: str) -> np.ndarray:
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    chosen = rows.orderBy(key.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([row.v for row in chosen], dtype=np.int64)


def moved(rows: DataFrame, points: np.ndarray) -> np.ndarray:
    """Centroids after one round: floors of the means; empty ones stay."""
    k, dimensions = points.shape
    shared = rows.sparkSession.sparkContext.broadcast(Centroids(points))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros((k, dimensions), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            block = block_of(batch, dimensions)
            best, _ = shared.value.nearest(block)
            by_cluster = np.argsort(best, kind="stable")
            present, low = np.unique(best[by_cluster], return_index=True)
            if len(present):
                sums[present] += np.add.reduceat(block[by_cluster], low, axis=0)
            sizes += np.bincount(best, minlength=k)
        used = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(sizes[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"]
        )

    parts = rows.select("v").mapInArrow(run, "cluster int, n long, sums array<long>")
    totals = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[d]) for d in range(dimensions)]).alias("sums")).collect()
    after = points.copy()
    for row in totals:
        after[row.cluster] = np.array(row.sums, dtype=np.int64) // row.n
    return after


def assigned(rows: DataFrame, points: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    shared = rows.sparkSession.sparkContext.broadcast(Centroids(points))
    dimensions = points.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, least = shared.value.nearest(block_of(batch, dimensions))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(best, pa.int32()), pa.array(least)], names=["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, cluster int, distance long")


def fit(rows: DataFrame, k: int = K, rounds: int = ROUNDS, salt: str = SALT) -> np.ndarray:
    """Final centroids over written whole vectors; no rows without vectors."""
    points = first_centroids(rows, k, salt)
    for _ in range(rounds if len(points) else 0):
        points = moved(rows, points)
    return points


def cluster(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dimensions: int = DIMENSIONS, k: int = K, rounds: int = ROUNDS, salt: str = SALT
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part."""
    spark = vectors.sparkSession
    ship(spark)
    rows = stored(whole_vectors(vectors, vec_id, embedding, dimensions), "cluster-vectors")
    points = fit(rows, k, rounds, salt)
    if not len(points):
        kind = rows.schema["vec_id"].dataType.simpleString()
        none = spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
        return none.withColumnRenamed("vec_id", vec_id)
    found = stored(assigned(rows, points), "cluster-found")
    sums = {row.cluster: row.total for row in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    # K rows at most.
    figures = [(c, own, sum(sums.values()), hashlib.sha256(",".join(map(str, points[c].tolist())).encode()).hexdigest()) for c, own in sums.items()]
    totals = spark.createDataFrame(figures, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(totals), "cluster").select(
        F.col("vec_id").alias(vec_id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
