"""Exact dedup by sorting contents: equal texts become neighbours.

Two texts are equal when they are identical after each run of white space has
become one space.  Spark samples splitters and range-partitions the normalised
texts; each partition is sorted, spilling to disk as needed, and one pass
compares every text with the one in front of it, byte by byte.  Of equal texts
the row with the smallest id stays.

Splitters go through the driver, so their size is bounded: rows are ordered by the
first HEAD characters of the normalised text, then by the digest of the whole,
then by its bytes, then by id.  Since the id is part of the splitters, a group of
copies of any size is spread over as many partitions as its rows fill.  The runs
at the borders of partitions are joined afterwards: the last text of a partition
is compared with the first of the next, and the sizes of runs that go on are
added.  Only numbers of partitions and runs, two a partition, pass one task.

NULL and empty text are one group; white space at either end counts as one space.
A NULL id comes behind all others.  Of rows equal in text and id, one stays.  Empty
table: no rows.  Further columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import ship, stored, text_of

HEAD = 32
# White space that is not yet one single space.
UNEVEN = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
INSIDE, FIRST, LAST, WHOLE = 0, 1, 2, 3  # place of a run in its partition


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, UNEVEN, " ")


def content_sorted(docs: DataFrame, doc_id: str, text: str, partitions: int | None) -> DataFrame:
    """(doc_id, norm, digest) in one total order over all partitions."""
    norm = docs.select(F.col(doc_id).alias("doc_id"), normalised(text_of(text)).alias("norm"))
    rows = norm.select("doc_id", "norm", F.substring("norm", 1, HEAD).alias("head"), F.unhex(F.sha2("norm", 256)).alias("digest"))
    last = F.col("doc_id").asc_nulls_last()
    dealt = rows.repartitionByRange(*([partitions] if partitions else []), F.col("head"), F.col("digest"), last)
    return dealt.sortWithinPartitions("head", "digest", "norm", last).select("doc_id", "norm", "digest")


class Runs:
    """Runs of equal neighbours in one sorted partition."""

    def __init__(self, schema: pa.Schema, pid: int):
        self.schema, self.pid = schema, pid
        self.open: list[pa.Array] = []  # ids of the run that may go on
        self.text = self.digest = None
        self.closed = 0

    def _rows(self, ids, keep, sizes, starts, digests, places) -> pa.RecordBatch:
        n = len(ids)
        empty = pa.nulls(n, pa.string())
        return pa.RecordBatch.from_arrays(
            [ids, keep, pa.array(sizes, pa.int64()), pa.array(starts, pa.bool_()), digests, pa.array(np.full(n, self.pid), pa.int32()), pa.array(places, pa.int32()), empty],
            schema=self.schema,
        )

    def _border(self, place: int, keep: pa.Array, size: int) -> pa.RecordBatch:
        """A row without a document: a run at the border, with its text."""
        values = [pa.nulls(1, keep.type), keep, [size], [False], pa.nulls(1, pa.binary()), [self.pid], [place], [self.text]]
        return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(values, self.schema)], schema=self.schema)

    def close(self, end: bool = False) -> Iterator[pa.RecordBatch]:
        """The rows of the open run, which is complete now."""
        if not self.open:
            return
        size = sum(map(len, self.open))
        place = (WHOLE if end else FIRST) if self.closed == 0 else LAST if end else INSIDE
        keep = self.open[0].slice(0, 1)
        for at, ids in enumerate(self.open):
            n = len(ids)
            same = keep.take(pa.array(np.zeros(n, np.int64)))
            digests = self.digest.take(pa.array(np.zeros(n, np.int64)))
            yield self._rows(ids, same, np.full(n, size), (np.arange(n) == 0) & (at == 0), digests, np.full(n, place))
        if place != INSIDE:
            yield self._border(place, keep, size)
        self.closed += 1
        self.open = []

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, texts, digests = (batch.column(c) for c in ("doc_id", "norm", "digest"))
        n = batch.num_rows
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = ~np.asarray(pc.equal(texts.slice(1), texts.slice(0, n - 1)))
        fresh[0] = not self.open or texts[0].as_py() != self.text
        starts = np.flatnonzero(fresh)
        goes_on = starts[0] if len(starts) else n
        if goes_on:
            self.open.append(ids.slice(0, goes_on))
        if not len(starts):
            return
        yield from self.close()
        if self.closed == 0 and len(starts) > 1:  # the first run of the partition is closed by itself, for its border
            self.open, self.text, self.digest = [ids.slice(0, starts[1])], texts[0].as_py(), digests.slice(0, 1)
            yield from self.close()
            starts = starts[1:]
        low, high = starts[0], starts[-1]
        if high > low:
            sizes = np.diff(starts)
            first = np.repeat(starts[:-1], sizes)
            yield self._rows(
                ids.slice(low, high - low), ids.take(pa.array(first)), np.repeat(sizes, sizes), fresh[low:high], digests.slice(low, high - low), np.zeros(high - low, np.int32)
            )
            self.closed += len(sizes)
        self.open, self.text, self.digest = [ids.slice(high)], texts[high].as_py(), digests.slice(high, 1)


def neighbours(ordered: DataFrame) -> DataFrame:
    """Every row with the run it is in, and the runs at the borders of partitions.

    (doc_id, keep_id, size, starts, digest, pid, place, text): ``keep_id`` and
    ``size`` are those of the run within the partition, ``starts`` marks its first
    row.  Rows with a text are the borders.
    """
    kind = ordered.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if runs is None:
                named = [("size", pa.int64()), ("starts", pa.bool_()), ("digest", pa.binary()), ("pid", pa.int32()), ("place", pa.int32()), ("text", pa.string())]
                id_type = batch.schema.field("doc_id").type
                runs = Runs(pa.schema([("doc_id", id_type), ("keep_id", id_type), *named]), TaskContext.get().partitionId())
            yield from runs.add(batch)
        if runs:
            yield from runs.close(end=True)

    return ordered.mapInArrow(
        run, f"doc_id {kind}, keep_id {kind}, size long, starts boolean, digest binary, pid int, place int, text string"
    )


def joined_borders(borders: DataFrame) -> DataFrame:
    """(pid, place, whole_keep, whole_size, heads) of each run at a border, with what it goes on from or into."""
    order = Window.orderBy("pid", "place")
    edges = borders.select("pid", "place", "keep_id", "size").withColumns({"p": F.lag("pid").over(order), "q": F.lag("place").over(order)})
    own = borders.select("pid", "place", F.col("text").alias("own"))
    front = borders.select(F.col("pid").alias("p"), F.col("place").alias("q"), F.col("text").alias("front"))
    # The last run of a partition differs from its first: only first ones can go on from another.
    same = edges.where((F.col("place") != LAST) & F.col("p").isNotNull()).join(own, ["pid", "place"]).join(front, ["p", "q"])
    same = same.select("pid", "place", (F.col("own") == F.col("front")).alias("same"))
    heads = ~F.coalesce("same", F.lit(False))
    chained = edges.join(same, ["pid", "place"], "left").withColumn("heads", heads)
    chained = chained.withColumn("chain", F.sum(F.col("heads").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = chained.groupBy("chain").agg(F.min_by(F.struct("keep_id"), F.struct("pid", "place")).alias("first"), F.sum("size").alias("whole_size"))
    return chained.join(whole, "chain").select("pid", "place", F.col("first.keep_id").alias("whole_keep"), "whole_size", "heads")


def content_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", partitions: int | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row, dropped ones too.

    ``partitions`` is the number of ranges, by default Spark's shuffle partitions.
    """
    ship(docs.sparkSession)
    # Written: ranges are sampled anew whenever they are computed anew.
    marked = stored(neighbours(content_sorted(docs, doc_id, text, partitions)), "content-runs")
    borders = stored(joined_borders(marked.where(F.col("text").isNotNull())), "content-borders")
    # At most two rows for each range.
    found = marked.where(F.col("text").isNull()).join(F.broadcast(borders), ["pid", "place"], "left")
    at_border = F.col("whole_size").isNotNull()
    return found.select(
        F.col("doc_id").alias(doc_id),
        F.when(at_border, F.col("whole_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("whole_size", "size").alias("group_size"),
        (F.col("starts") & F.coalesce("heads", F.lit(True))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
