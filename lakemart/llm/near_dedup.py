"""Near-duplicate documents by improved consistent weighted sampling.

Shingles of five lower-cased words weigh term frequency times inverse document
frequency, log(N / df), scaled so that the rarest have 1 and rounded to steps of
2^(1/4); the least is 1/8.  Document frequencies of all shingles come from a
count-min sketch of fixed size: what lies below its noise counts as rare.
Copies of one text count as one document, or a large group of copies would make
its own shingles common and fall apart: a text of which COPIED or more is
frequent belongs to the family of its least frequent-shingle hash, which few
changes leave alone, and a family counts once.

Equal texts share one node.  Each node gets SAMPLES weighted samples in BANDS
bands; nodes with one equal band form a bucket.  The members of a bucket are
compared with its least node, and links found so far are joined into components.
Pairs of which fewer than AGREE samples agree are not compared word by word.
Members that this leaves in other components than the leader are compared with
all the rest of the bucket, in blocks of bounded size; by the triangle inequality
of 1 - similarity, members very near to the leader can be left out.  Every
comparison is the exact weighted Jaccard similarity of the whole texts.

Links join nodes into classes.  NULL or empty text (no words): a class of its
own.  Texts under five words have one shingle, all their words.  Rows equal in
id and text are one document.  Empty table: no rows.  Further columns are left
alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import set_aside, ship, slices, stored, text_of
from lakemart.llm.graph import components
from lakemart.llm.hashing import mix, windows, word_hashes

SHINGLE = 5
BANDS, ROWS = 12, 3
SAMPLES = BANDS * ROWS
SIMILAR = 0.8
BLOCK = 256
SKETCH_ROWS, SKETCH_BITS = 2, 17
AGREE = 18  # of SAMPLES: at a similarity of 0.8, fewer agree about once in 100,000 pairs
MARGIN = 0.25  # how far a similarity may lie above its estimate from the samples
OCTAVE = 4  # weights are powers of 2^(1 / OCTAVE)
COPIED = 2 / 3  # texts of one length that have so much in common have a plain similarity of 1/2
SMALL = 8  # families of fewer members than this part of the noise stay as they are
UNIT = 1 << 20  # of a document, in whole numbers: sums come out the same in any order
LEAST, MOST = -3 * OCTAVE, 12 * OCTAVE  # exponents
NOISE = 4  # standard deviations of a count
TABLE_BITS = 14
CHUNK = 8192

_rng = np.random.default_rng(20240501)
_step = _rng.gamma(2, 1, 1 << TABLE_BITS)
_scale = np.log(_rng.gamma(2, 1, 1 << TABLE_BITS))
_shift = _rng.random(1 << TABLE_BITS)
_logs = np.arange(LEAST, MOST + 1)[:, None] * (np.log(2) / OCTAVE)
LEVEL = np.floor(_logs / _step + _shift)
VALUE = (_scale - _step * (LEVEL - _shift + 1)).astype(np.float32).ravel()
LEVEL = LEVEL.astype(np.int64).ravel()
FACTORS = (_rng.integers(1, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order, with how often each occurs."""
    hashes = word_hashes(text.lower().encode("utf-8", "surrogatepass"))
    if not len(hashes):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.unique(windows(hashes, min(SHINGLE, len(hashes))), return_counts=True)


def cells(hashes: np.ndarray) -> np.ndarray:
    """The cell of each hash in each row of the sketch: other bits for each row."""
    place = [(hashes >> np.uint64(64 - (row + 1) * SKETCH_BITS)).astype(np.int64) & ((1 << SKETCH_BITS) - 1) for row in range(SKETCH_ROWS)]
    return np.stack([p + (row << SKETCH_BITS) for row, p in enumerate(place)])


def noise_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What unrelated shingles put into a cell of each row, and how far that may vary."""
    mean = counts.reshape(SKETCH_ROWS, -1).mean(axis=1, keepdims=True)
    return mean, NOISE * np.sqrt(mean) + 1


@dataclass(frozen=True)
class Frequencies:
    """Weights that follow from a sketch of document frequencies."""

    steps: np.ndarray  # by cell: exponent of the weight of a shingle that occurs once

    @classmethod
    def of(cls, counts: np.ndarray, documents: int) -> Frequencies:
        """Inverse document frequencies, scaled so that rare shingles weigh 1.

        What unrelated shingles put into a cell on average is taken off; below
        the noise that is left no frequency can be told from another.
        """
        by_row = counts.reshape(SKETCH_ROWS, -1)
        mean, noise = noise_of(counts)
        seen, whole = np.maximum(by_row - mean, noise), np.maximum(documents, 2 * noise)
        rarity = np.clip(np.log(whole / seen) / np.log(whole / noise), 2.0 ** (LEAST / OCTAVE), 1)
        return cls(np.rint(np.log2(rarity) * OCTAVE).astype(np.int8).ravel())

    def frequent(self, hashes: np.ndarray) -> np.ndarray:
        """Which shingles weigh less than a rare one."""
        return self.steps[cells(hashes)].max(axis=0) < 0

    def exponents(self, hashes: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Weights as exponents: term frequency times inverse document frequency."""
        found = self.steps[cells(hashes)].max(axis=0).astype(np.int64)
        often = np.flatnonzero(times > 1)
        found[often] = np.clip(found[often] + np.rint(np.log2(times[often]) * OCTAVE).astype(np.int64), LEAST, MOST)
        return found


def frequencies(rows: DataFrame) -> Frequencies:
    """Document frequencies over all rows, as a table of fixed size; copies count once."""
    counts, documents = _counted(rows.select("text"), lambda texts: np.ones(len(texts), dtype=np.int64))
    known = Frequencies.of(counts, documents)
    copies = stored(_families(rows, known), "near-families")
    least = max(2, int(noise_of(counts)[1].min() / SMALL))
    # A family listed takes up that much of the noise: their number grows as the square root of the documents.
    large = copies.groupBy("family").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).orderBy("family").toPandas()
    if large.empty:
        return known
    family, n = large.family.to_numpy(dtype=np.int64), large.n.to_numpy(dtype=np.int64)
    shared = rows.sparkSession.sparkContext.broadcast((family, UNIT - np.maximum(UNIT // n, 1)))

    def too_much(families: np.ndarray) -> np.ndarray:
        listed, surplus = shared.value
        place = np.minimum(np.searchsorted(listed, families), len(listed) - 1)
        return np.where(listed[place] == families, surplus[place], 0)

    less, fewer = _counted(copies, too_much, "family")
    return Frequencies.of((counts * UNIT - less) / UNIT, (documents * UNIT - fewer) / UNIT)


def _counted(rows: DataFrame, units: Callable, by: str = "text") -> tuple[np.ndarray, int]:
    """Sums by cell and over all texts of a number for each text, which ``units`` gives from column ``by``."""
    last = SKETCH_ROWS << SKETCH_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(last + 1, dtype=np.int64)
        for batch, texts in slices(batches, "text"):
            each = units(batch.column(by).to_numpy(zero_copy_only=False))
            for n in np.unique(each[each > 0]):
                places = [cells(shingles(texts[at])[0]).ravel() for at in np.flatnonzero(each == n)]
                total[:last] += n * np.bincount(np.concatenate(places), minlength=last)
            total[last] += each.sum()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["cell", "n"])

    found = rows.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(last + 1, dtype=np.int64)
    counts[found.cell.to_numpy(dtype=np.int64)] = found.n.to_numpy(dtype=np.int64)
    return counts[:last], int(counts[last])


def _families(rows: DataFrame, known: Frequencies) -> DataFrame:
    """(family, text) of the texts that consist mostly of frequent shingles."""
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            family, chosen = [], []
            for at, text in enumerate(texts):
                hashes, _ = shingles(text)
                frequent = hashes[shared.value.frequent(hashes)]
                if len(frequent) and len(frequent) >= COPIED * len(hashes):
                    family.append(mix(frequent).min())
                    chosen.append(at)
            texts = batch.column("text").take(pa.array(chosen, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(family, dtype=np.uint64).view(np.int64)), texts], names=["family", "text"])

    return rows.select("text").mapInArrow(run, "family long, text string")


def samples(hashes: np.ndarray, exponents: np.ndarray) -> np.ndarray:
    """SAMPLES consistent weighted samples of a weighted set, as (shingle hash, level) pairs.

    Weights come in few steps, so the value that a draw has with a weight is one
    look into a table.
    """
    best = np.full(SAMPLES, np.inf, dtype=np.float32)
    chosen = np.zeros((2, SAMPLES), dtype=np.uint64)
    rows, short = np.arange(SAMPLES), (hashes >> np.uint64(32)).astype(np.uint32)
    base = ((exponents - LEAST) << TABLE_BITS).astype(np.uint32)
    for low in range(0, len(hashes), CHUNK):
        part = hashes[low : low + CHUNK]
        drawn = short[None, low : low + CHUNK] * FACTORS
        drawn >>= np.uint32(32 - TABLE_BITS)
        drawn += base[None, low : low + CHUNK]
        value = VALUE.take(drawn)
        at = value.argmin(axis=1)
        least = value[rows, at]
        better = least < best
        best[better] = least[better]
        chosen[0, better] = part[at[better]]
        chosen[1, better] = LEVEL[drawn[rows, at][better]].view(np.uint64)
    return chosen


def named(chosen: list[np.ndarray]) -> np.ndarray:
    """(texts, SAMPLES) one number for each sample."""
    pairs = np.stack(chosen)
    return mix(pairs[:, 0] ^ mix(pairs[:, 1]))


def bands(numbers: np.ndarray) -> np.ndarray:
    """(texts, BANDS) bucket numbers."""
    grouped = numbers.reshape(-1, BANDS, ROWS)
    bucket = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), grouped.shape[:2])
    for column in range(ROWS):
        bucket = mix(bucket * np.uint64(0x9FB21C651E98DF25) + grouped[:, :, column])
    return bucket.view(np.int64)


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples; sketches along the last axis."""
    return (a == b).mean(axis=-1)


def sketch_rows(column: pa.Array) -> np.ndarray:
    """(rows, SAMPLES) 16 bits of every sample."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, SAMPLES)


def weighted(text: str, known: Frequencies) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of a text in order, with their weights."""
    hashes, times = shingles(text)
    return hashes, np.exp2(known.exponents(hashes, times) / OCTAVE)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    place = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    both = a[0][place] == b[0]
    shared = np.minimum(a[1][place[both]], b[1][both]).sum()
    return float(shared / (a[1].sum() + b[1].sum() - shared))


def nodes_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    whole = text_of(text)
    return docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.md5(whole)).alias("node"), whole.alias("text"))


def signatures(rows: DataFrame, known: Frequencies) -> DataFrame:
    """(doc_id, node, buckets, sketch) of every document; no buckets and no sketch without words."""
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            chosen, worded = [], np.zeros(len(texts), dtype=bool)
            for at, text in enumerate(texts):
                hashes, times = shingles(text)
                if len(hashes):
                    worded[at] = True
                    chosen.append(samples(hashes, shared.value.exponents(hashes, times)))
            numbers = named(chosen) if chosen else np.empty((0, SAMPLES), np.uint64)
            offsets = np.concatenate([[0], np.cumsum(worded * BANDS)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands(numbers).ravel()))
            short = iter(numbers.astype(np.uint16))
            sketches = pa.array([next(short).tobytes() if w else None for w in worded], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), lists, sketches], names=["doc_id", "node", "buckets", "sketch"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, node binary, buckets array<long>, sketch binary")


def compared(pairs: DataFrame, texts: DataFrame, known: Frequencies) -> DataFrame:
    """(a, b, similarity, bound) of pairs of nodes.

    Pairs whose samples rule a similarity of SIMILAR out are not compared word by
    word; they get an upper ``bound`` that lies below it.
    """
    shared = pairs.sparkSession.sparkContext.broadcast(known)
    with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"), F.col("sketch").alias("sketch_a")), "a")
    with_both = with_a.join(texts.select(F.col("node").alias("b"), "text", "sketch"), "b").select("a", "b", "text_a", "sketch_a", "text", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts_b in slices(batches, "text"):
            nodes_a, leader = batch.column("a").to_pylist(), {}
            alike = agreement(sketch_rows(batch.column("sketch_a")), sketch_rows(batch.column("sketch")))
            similar = np.minimum(alike + MARGIN, np.nextafter(SIMILAR, 0))
            for at in np.flatnonzero(alike * SAMPLES >= AGREE):
                node = nodes_a[at]
                if node not in leader:
                    leader = {node: weighted(batch.column("text_a")[at].as_py(), shared.value)}  # rows of one leader often follow each other
                similar[at] = weighted_jaccard(leader[node], weighted(texts_b[at], shared.value))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(similar, pa.float64()), pa.array(alike * SAMPLES < AGREE)],
                names=["a", "b", "similarity", "bound"],
            )

    return with_both.mapInArrow(run, "a binary, b binary, similarity double, bound boolean")


def links(nodes: DataFrame, rows: DataFrame, known: Frequencies) -> DataFrame:
    """(a, b) of compared nodes with a similarity of SIMILAR or more; enough to join all classes."""
    placed = stored(nodes.select(F.explode("buckets").alias("bucket"), "node"), "near-bands")
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).where(F.col("n") > 1)
    members = stored(placed.join(shared.select("bucket", "leader"), "bucket"), "near-buckets")
    involved = members.select("node").distinct()
    # One written copy of each text that has a partner; equal texts meet before the exchange.
    texts = rows.join(involved, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    texts = stored(texts.join(nodes, "node"), "near-texts")
    followers = members.where(F.col("node") != F.col("leader"))
    pairs = followers.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    results = stored(compared(pairs, texts, known), "near-compared")
    told = followers.join(results.select(F.col("a").alias("leader"), F.col("b").alias("node"), "similarity", "bound"), ["leader", "node"])
    linked = results.where(F.col("similarity") >= SIMILAR).select("a", "b")
    return linked.unionByName(_rest(told, components(linked), texts, known))


def _rest(told: DataFrame, label: DataFrame, texts: DataFrame, known: Frequencies) -> DataFrame:
    """Links between members of one bucket that no leader has joined yet.

    ``others`` of a bucket belong to other components than its leader.  They are
    compared with each other and with the leader's side in blocks of BLOCK
    nodes, so no group grows with the bucket.
    """
    own = F.coalesce("own", "node")
    sided = (
        told.join(label.select("node", F.col("label").alias("own")), "node", "left")
        .join(label.select(F.col("node").alias("leader"), F.col("label").alias("theirs")), "leader", "left")
        .select("bucket", "node", "similarity", "bound", own.alias("label"), (own != F.coalesce("theirs", "leader")).alias("other"))
    )
    sided = stored(sided, "near-sided")
    sizes = sided.groupBy("bucket").agg(
        F.count_if("other").alias("others"), F.count_if(~F.col("other")).alias("side"), F.max(F.when(F.col("other"), F.col("similarity"))).alias("most")
    )
    sizes = sizes.where((F.col("others") > 1) | ((F.col("others") > 0) & (F.col("side") > 0)))
    # A member that near to the leader cannot be linked to one that failed by more; of a bound nobody knows how near.
    near = F.col("bound") | (F.col("similarity") <= F.col("most") + (1 - SIMILAR))
    blocks = sided.join(sizes, "bucket").where(F.col("other") | near)
    many = F.ceil(F.col("others") / BLOCK).cast("int"), F.ceil(F.col("side") / BLOCK).cast("int")
    blocks = blocks.withColumns({"o": many[0], "c": many[1]})
    blocks = blocks.withColumn("at", F.pmod(F.hash("node"), F.when(F.col("other"), F.col("o")).otherwise(F.col("c"))))

    def upto(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def group(i, j, kind):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(kind).alias("kind"))

    at = F.col("at")
    among = F.transform(upto(F.col("o")), lambda j: group(F.least(at, j), F.greatest(at, j), "others"))
    across = F.transform(upto(F.col("c")), lambda j: group(at, j, "side"))
    against = F.transform(upto(F.col("o")), lambda i: group(i, at, "side"))
    dealt = blocks.withColumn("g", F.explode(F.when(F.col("other"), F.concat(among, across)).otherwise(against)))
    dealt = dealt.select("bucket", "g.*", "node", "label", "other", "at", "similarity").join(texts, "node")
    shared = texts.sparkSession.sparkContext.broadcast(known)
    found = dealt.groupBy("bucket", "i", "j", "kind").applyInPandas(
        lambda rows: joining_links(rows, shared.value), "a binary, b binary"
    )
    return found


def joining_links(rows: pd.DataFrame, known: Frequencies) -> pd.DataFrame:
    """One link for each two components that two blocks of a bucket join.

    Two nodes are compared in the first bucket they share, and in no other.
    """
    sets = {}

    def of(row: int) -> tuple[np.ndarray, np.ndarray]:
        if row not in sets:
            sets[row] = weighted(rows.text.iloc[row], known)
        return sets[row]

    kind, i, j = rows.kind.iloc[0], rows.i.iloc[0], rows.j.iloc[0]
    other, at = rows.other.to_numpy(), rows["at"].to_numpy()
    left = np.flatnonzero(other & (at == i))
    right = np.flatnonzero(other & (at == j)) if kind == "others" else np.flatnonzero(~other)
    sketches = np.frombuffer(b"".join(rows.sketch), dtype=np.uint16).reshape(-1, SAMPLES)
    nodes, out = rows.node.to_list(), []
    component = np.unique([bytes(x) for x in rows.label], return_inverse=True)[1]
    bucket, buckets = rows.bucket.iloc[0], np.stack(rows.buckets.to_numpy())
    for a in left:
        first = buckets[a][(buckets[right] == buckets[a]).argmax(axis=1)] == bucket
        mine = right[first & (component[right] != component[a])]
        for b in mine[agreement(sketches[mine], sketches[a]) * SAMPLES >= AGREE]:
            if component[b] != component[a] and weighted_jaccard(of(a), of(b)) >= SIMILAR:
                out.append((bytes(nodes[a]), bytes(nodes[b])))
                component[component == component[b]] = component[a]
    return pd.DataFrame(out, columns=["a", "b"])


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, node, class_id, first): the class of every document.

    ``class_id`` is the least id of the class (NULLs aside); ``first`` marks the
    rows that stand for their class.
    """
    ship(docs.sparkSession)
    rows = nodes_of(docs, doc_id, text)
    known = frequencies(rows)
    signed = stored(signatures(rows, known), "near-signatures")
    worded = signed.where(F.size("buckets") > 0)
    nodes = stored(
        worded.groupBy("node").agg(F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "near-nodes"
    )
    label = components(links(nodes.select("node", "buckets", "sketch"), rows, known))
    joined = nodes.select("node", "least").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    joined = stored(joined, "near-joined")
    heads = joined.groupBy("label").agg(F.min("least").alias("class_id"), F.min_by("node", F.struct("least", "node")).alias("head"))
    verdict = joined.join(heads, "label").select("node", "class_id", "head", "least")
    found = signed.select("doc_id", "node").join(verdict, "node", "left")
    first = F.col("head").isNull() | ((F.col("head") == F.col("node")) & F.col("doc_id").eqNullSafe(F.col("least")))
    alone = F.col("head").isNull()
    return found.select("doc_id", "node", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), first.alias("first"))


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its class."""
    return classes(docs, doc_id, text).select(F.col("doc_id").alias(doc_id), "class_id", "first")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stand for their class, one for each; all columns."""
    kept = stored(classes(docs, doc_id, text).where("first").select(F.col("doc_id").alias("__id"), F.col("node").alias("__kept")), "near-kept").distinct()
    named, back = set_aside(docs)
    keyed = named.withColumn("__node", F.unhex(F.md5(text_of(text))))
    on = F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__node") == F.col("__kept"))
    return back(keyed.join(kept, on, "left_semi").dropDuplicates([doc_id, "__node"]).select(*named.columns))
