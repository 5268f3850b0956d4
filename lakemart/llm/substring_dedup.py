"""Substring dedup: FM-indexes per shard find word windows that occur twice.

A window is ``window`` consecutive words of one document.  Equal windows must
meet in one shard, so shards are cut by content: the least hash among a window's
five-word grams is its anchor, and a run of windows with one anchor is a
segment.  Equal windows have equal anchors.

1. Anchors are counted.  An anchor met once cannot belong to a repeated window;
   a bit map of fixed size over the others lets most segments stay at home (a
   false hit costs work, never a result).
2. Segments of the others are written as hashes with their place.  Equal ones
   are counted, which takes away groups of copies before any text moves.
   Anchors in more than a ``hot_share`` of all anchors' places are no shards: their
   windows go on one by one, by their own hash.
3. The words of one copy of each distinct segment go to its shard.  The shard
   builds a compressed FM-index, streams its segments against it by backward
   search, and gets for every place the longest run found at least twice.
   Intervals of windows at or above the threshold are reported.
4. The intervals go back to all documents that hold the segment.

Segments count as equal if two 64-bit hashes are, words inside a shard if 48 bits
of theirs are.  NULL or empty text: no words.
Repeated rows repeat their windows, so all of theirs are removed; such rows
(equal id and text) share one key.  NULL ids are a key like any other.  Empty
table: no rows.  Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakemart.llm.common import sha256, ship, slices, stored, text_of
from lakemart.llm.fm_index import DEPTH, FmIndex, matching_statistics
from lakemart.llm.hashing import Prefixes, windows, word_hashes

GRAM = 5
MAP_BITS = 27  # the bit map of anchors met twice takes 16 MB
SHARD_SEGMENTS = 20_000
KEY = ("key_id", "key_hash")
UPPER = np.uint64(0xFFFFFFFF00000000)
SENT = 6  # bytes of a word's hash that go to a shard


def encoded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def doc_words(text: str) -> list[bytes]:
    """Words of a text; bytes split at exactly the six white-space characters."""
    return encoded(text).split()


def anchor_places(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of each window's anchor: the leftmost least gram hash inside."""
    grams = windows(hashes, GRAM)
    inside = window - GRAM + 1
    if len(hashes) < window:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    # The upper half of the hash, then the place: the least is the leftmost of equals.
    least = (grams & UPPER) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while reach < inside:
        step = min(reach, inside - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    places = (least & ~UPPER).astype(np.int64)
    return grams[places], places


def segments(hashes: np.ndarray, window: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, content hash, first window, number of windows) of each segment.

    A window with a hot anchor is a segment of its own, anchored by its content.
    """
    anchors, places = anchor_places(hashes, window)
    if not len(anchors):
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), np.empty(0, np.uint64), none, none
    new = np.concatenate([[True], places[1:] != places[:-1]])
    is_hot = np.isin(anchors, hot) if len(hot) else np.zeros(len(anchors), bool)
    # A segment must stay shorter than the index sorts.
    run = np.arange(len(new)) - np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    new |= (run % (DEPTH - window)) == 0
    new |= is_hot
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(new)))
    content = Prefixes(hashes).of(starts, counts + window - 1)
    return np.where(is_hot[starts], content, anchors[starts]), content, starts, counts


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Id and whole text under a key that equal rows share."""
    whole = text_of(text)
    return docs.select(F.col(doc_id).cast("long").alias("key_id"), F.xxhash64(whole).alias("key_hash"), whole.alias("text"))


def rows_once(rows: DataFrame) -> DataFrame:
    """One row for all rows equal in id and text, with their number in ``times``."""
    named = rows.select(*KEY).groupBy(*KEY).agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > 1)
    again = stored(named.select(F.col("key_id").alias("a_id"), F.col("key_hash").alias("a_hash"), "times"), "substr-equal-rows")
    if again.isEmpty():
        return rows.withColumn("times", F.lit(1).cast("long"))
    on = F.col("key_id").eqNullSafe(F.col("a_id")) & (F.col("key_hash") == F.col("a_hash"))
    single = rows.join(again, on, "left_anti").withColumn("times", F.lit(1).cast("long"))
    return single.unionByName(rows.join(again, on).select(*rows.columns, "times").dropDuplicates(list(KEY)))


def repeated_anchors(rows: DataFrame, window: int) -> DataFrame:
    """(anchor, n) of all anchors met at least twice, rows counted ``times``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            found = [np.empty(0, np.uint64)]
            more = [(np.empty(0, np.uint64), 0)]
            for text, times in zip(texts, batch.column("times").to_pylist()):
                anchors, places = anchor_places(word_hashes(encoded(text)), window)
                if len(anchors):
                    found.append(anchors[np.concatenate([[True], places[1:] != places[:-1]])])
                    if times > 1:
                        more.append((found[-1], times - 1))
            values, counts = np.unique(np.concatenate(found), return_counts=True)
            for anchors, times in more:
                np.add.at(counts, np.searchsorted(values, anchors), times)
            yield pa.RecordBatch.from_arrays([pa.array(signed(values)), pa.array(counts.astype(np.int64))], names=["anchor", "n"])

    counted = rows.select("text", "times").mapInArrow(run, "anchor long, n long")
    return counted.groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") > 1)


def bit_of(anchor: np.ndarray) -> np.ndarray:
    return anchor.astype(np.uint64) >> np.uint64(64 - MAP_BITS)


def bit_map(anchors: DataFrame) -> np.ndarray:
    """One bit for the upper MAP_BITS of every anchor; its size does not depend on the data."""
    bits = anchors.select(F.shiftrightunsigned("anchor", 64 - MAP_BITS).alias("bit"))
    packed = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 AS int)))").alias("bits"))
    cells = packed.toPandas()
    out = np.zeros(1 << (MAP_BITS - 6), dtype=np.int64)
    out[cells.word.to_numpy(dtype=np.int64)] = cells.bits.to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def placed_segments(rows: DataFrame, window: int, bits: np.ndarray, hot: np.ndarray) -> DataFrame:
    """(anchor, content, key, times, first, windows) of the segments whose anchor may be met twice."""
    shared = rows.sparkSession.sparkContext.broadcast((bits, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hot_anchors = shared.value
        for batch, texts in slices(batches, "text"):
            parts: list[list[np.ndarray]] = [[], [], [], [], []]
            for row, text in enumerate(texts):
                anchor, content, first, count = segments(word_hashes(encoded(text)), window, hot_anchors)
                place = bit_of(anchor).astype(np.int64)
                single = anchor == content  # of a hot anchor: not in the map
                maybe = single | ((known[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
                for part, values in zip(parts, (anchor, content, first, count, np.full(len(anchor), row))):
                    part.append(values[maybe])
            owner = pa.array(np.concatenate(parts[4]).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(np.concatenate(parts[0]))), pa.array(signed(np.concatenate(parts[1])))]
                + [batch.column(k).take(owner) for k in (*KEY, "times")]
                + [pa.array(np.concatenate(parts[i]).astype(np.int32)) for i in (2, 3)],
                names=["anchor", "content", *KEY, "times", "first", "windows"],
            )

    return rows.mapInArrow(run, "anchor long, content long, key_id long, key_hash long, times long, first int, windows int")


def segment_words(texts: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(anchor, content, n, words) of the wanted segments, words as packed hashes of SENT bytes."""
    lists = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "content", "n", "first", "windows")).alias("segments"))
    lists = lists.select(*(F.col(k).alias(f"w_{k}") for k in KEY), "segments")
    on = F.col("key_id").eqNullSafe(F.col("w_key_id")) & (F.col("key_hash") == F.col("w_key_hash"))
    joined = texts.join(lists, on).select("text", "segments", *KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch, texts in slices(batches, "text"):
            keys = list(zip(batch.column("key_id").to_pylist(), batch.column("key_hash").to_pylist()))
            # Equal rows follow each other: the first will do.
            new = [key != before for key, before in zip(keys, [last, *keys])]
            last = keys[-1] if keys else last
            if not all(new):
                batch, texts = batch.filter(pa.array(new)), [t for t, n in zip(texts, new) if n]
            column = batch.column("segments")
            fields = column.flatten().flatten()
            first, count = fields[3].to_numpy(), fields[4].to_numpy()
            lengths = pc.list_value_length(column).to_numpy()
            words, at = [], 0
            for text, size in zip(texts, lengths):
                packed = word_hashes(encoded(text)).view(np.uint8).reshape(-1, 8)[:, :SENT].tobytes()
                for i in range(at, at + size):
                    words.append(packed[first[i] * SENT : (first[i] + count[i] + window - 1) * SENT])
                at += size
            yield pa.RecordBatch.from_arrays([*fields[:3], pa.array(words, pa.binary())], names=["anchor", "content", "n", "words"])

    return joined.mapInArrow(run, "anchor long, content long, n long, words binary")


def search_shard(group: pd.DataFrame, window: int) -> pd.DataFrame:
    """Intervals of windows, counted within their segment, whose words occur twice."""
    # Equal segments that came from equal rows are one.
    group = group.drop_duplicates(["anchor", "content"])
    sizes = np.array([len(w) // SENT for w in group.words], dtype=np.int64)
    spread = np.zeros((int(sizes.sum()), 8), dtype=np.uint8)
    spread[:, :SENT] = np.frombuffer(b"".join(group.words), dtype=np.uint8).reshape(-1, SENT)
    symbols = np.unique(spread.view(np.uint64)[:, 0], return_inverse=True)[1].astype(np.int64) + 1
    index = FmIndex(symbols, sizes)
    found = matching_statistics(index, symbols, sizes, group.n.to_numpy(), window) >= window
    edge = np.diff(np.concatenate([[0], found.astype(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # The last places of a segment start no window, so no interval crosses a border.
    owner = np.searchsorted(np.cumsum(sizes), start, side="right")
    return pd.DataFrame(
        {
            "anchor": group.anchor.to_numpy()[owner],
            "content": group.content.to_numpy()[owner],
            "shift": (start - (np.cumsum(sizes) - sizes)[owner]).astype(np.int32),
            "count": (stop - start).astype(np.int32),
        }
    )


def repeated_windows(docs: DataFrame, window: int = 35, doc_id: str = "doc_id", text: str = "text", hot_share: float = 1e-4) -> DataFrame:
    """(key_id, key_hash, intervals): the windows of each document that occur twice.

    ``intervals`` are (first, count) of consecutive windows; documents without
    any are left out.
    """
    if not GRAM <= window < DEPTH:
        raise ValueError(f"a window takes {GRAM} to {DEPTH - 1} words")
    ship(docs.sparkSession)
    rows = keyed(docs, doc_id, text)
    once = rows_once(rows)
    anchors = stored(repeated_anchors(once, window), "substr-anchors")
    total = anchors.agg(F.sum("n")).first()[0] or 0
    limit = max(SHARD_SEGMENTS, int(total * hot_share))  # so fewer than 1 / hot_share anchors are hot
    hot = np.array([r[0] for r in anchors.where(F.col("n") > limit).select("anchor").collect()], dtype=np.int64).view(np.uint64)
    placed = stored(placed_segments(once, window, bit_map(anchors), hot), "substr-segments")
    # One number for both, since every distinct segment carries it through the exchange.
    place = F.shiftleft(F.col("first").cast("long"), 32) + F.col("windows")
    distinct = placed.groupBy("anchor", "content").agg(
        F.sum("times").alias("n"), F.min(F.struct("key_id", "key_hash", place.alias("place"))).alias("copy")
    )
    together = F.sum("n").over(Window.partitionBy("anchor"))
    wanted = stored(
        distinct.withColumn("total", together).where(F.col("total") > 1).select(
            "anchor", "content", "n", "copy.key_id", "copy.key_hash",
            F.shiftright("copy.place", 32).cast("int").alias("first"), F.col("copy.place").bitwiseAND(0x7FFFFFFF).cast("int").alias("windows"),
        ), "substr-distinct",
    )
    shards = max(1, -(-wanted.count() // SHARD_SEGMENTS))
    words = segment_words(rows.repartition(*KEY), wanted, window)
    found = words.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")).applyInPandas(
        lambda group: search_shard(group, window), "anchor long, content long, shift int, count int"
    )
    hits = placed.join(found, ["anchor", "content"]).select(
        *KEY, F.struct((F.col("first") + F.col("shift")).alias("first"), F.col("count")).alias("hit")
    )
    return hits.groupBy(*KEY).agg(F.collect_list("hit").alias("intervals"))


def covered_words(intervals: list[dict], n: int, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a reported window."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for hit in intervals or ():
        edge[hit["first"]] += 1
        edge[hit["first"] + hit["count"] + window - 1] -= 1
    return np.cumsum(edge[:-1]) > 0


def remove_repeated(
    docs: DataFrame, window: int = 35, doc_id: str = "doc_id", text: str = "text", digests: bool = False
) -> DataFrame:
    """Per document: n_words, n_removed and the kept words joined by one space.

    ``digests`` returns kept_sha256 in place of the kept text.
    """
    hits = repeated_windows(docs, window, doc_id, text)
    hits = hits.select(*(F.col(k).alias(f"h_{k}") for k in KEY), "intervals")
    rows = keyed(docs, doc_id, text).repartition(*KEY)  # the exchange that fetches words serves here again
    on = F.col("key_id").eqNullSafe(F.col("h_key_id")) & (F.col("key_hash") == F.col("h_key_hash"))
    joined = rows.join(hits, on, "left").select("key_id", "text", "intervals")
    last = "kept_sha256" if digests else "kept"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            sizes, removed, kept = [], [], []
            for value, intervals in zip(texts, batch.column("intervals").to_pylist()):
                words = doc_words(value)
                gone = covered_words(intervals, len(words), window)
                left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g]).decode("utf-8", "surrogatepass")
                sizes.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(sha256(left) if digests else left)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=[doc_id, "n_words", "n_removed", last],
            )

    schema = StructType(
        [StructField(doc_id, LongType()), StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField(last, StringType())]
    )
    return joined.mapInArrow(run, schema)
