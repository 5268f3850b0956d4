"""Divergence of the sources of a language from each other and from the language.

Terms are runs of letters (A-Z made small, all that is not ASCII counts as
letter).  A language keeps the terms that stand in at least MIN_DOCS of its
documents.  Every source of a language, and the language itself, gives each kept
term the scaled probability ``1 + floor(SCALE * (count + 2) / (N + 2 * V))``; two
of them differ in a term by ``floor((p - q)^2 / (p + q))``.

Pairs are worked out as a cube.  The sources of a language are dealt into blocks
of about GROUP_BLOCK, its kept terms into blocks of about TERM_BLOCK, and a task
owns a cell (source block, source block, term block).  Only counts above zero
travel, replicated to the cells that need them; a term without a count has its
source's floor probability, so each cell also gets that floor of every source it
holds and the number of terms in its block.  Cells return partial sums, which
are added along the term axis.

NULL text, language and source count as ''.  A text without terms still makes its
source occur.  Every row is a document of its own, repeated rows too.  Equal
values rank by the item's UTF-8 bytes.  Empty table: no rows.  Further columns
are left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import ship, stored

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10
GROUP_BLOCK, TERM_BLOCK = 64, 2048
ENTRIES = 300_000  # counts a task holds before it passes them on
PIECE = 1 << 20
# Bytes of terms stay, A-Z become small, all others separate.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of about PIECE bytes."""
    plain, low = text.translate(LETTERS), 0
    while low < len(plain):
        high = plain.find(b" ", low + PIECE)
        high = len(plain) if high < 0 else high
        yield plain[low:high].split()
        low = high


class Tally:
    """Occurrences and documents of the terms of (language, source) groups."""

    def __init__(self):
        self.times: dict[tuple[str, str], Counter] = {}
        self.docs: dict[tuple[str, str], Counter] = {}

    def add(self, group: tuple[str, str], text: bytes) -> int:
        """Count a document; the number of new entries."""
        times, docs = self.times.setdefault(group, Counter()), self.docs.setdefault(group, Counter())
        before, seen = len(times), set()
        for terms in pieces(text):
            times.update(terms)
            seen.update(terms)
        docs.update(seen)
        return len(times) - before

    def batches(self) -> Iterator[pa.RecordBatch]:
        """One batch per group; its first row, without a term, says that the group occurs."""
        for (lang, source), times in self.times.items():
            docs = self.docs[lang, source]
            terms, size = [None, *times], len(times) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size, pa.string()),
                    pa.array([source] * size, pa.string()),
                    pa.array(terms, pa.binary()),
                    pa.array([0, *times.values()], pa.int64()),
                    pa.array([0, *(docs[t] for t in times)], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )


def count_terms(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, docs), added up within tasks before anything moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, held = Tally(), 0
        for batch in batches:
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for group, body in zip(groups, pc.cast(batch.column("text"), pa.binary())):
                held += tally.add(group, body.as_py())
                if held > ENTRIES:
                    yield from tally.batches()
                    tally, held = Tally(), 0
        yield from tally.batches()

    def read(name: str, column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name)

    rows = docs.select(read("lang", lang), read("source", source), read("text", text))
    found = rows.mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    return found.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(count: str, total: str, terms: str) -> Column:
    """The scaled probability; the product is a decimal, since it can pass 64 bits."""
    return F.expr(f"1 + (CAST({count} AS DECIMAL(20, 0)) + 2) * {SCALE} div ({total} + 2 * {terms})").cast("long")


def difference(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})").cast("long")


def ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def cell_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """Partial divergences of one cell: (a, b, value) for a in its first and b in its second block.

    Rows with tid -1 are the cell's sources with their floor probability and the
    number of terms of the block; the others are terms with a count.
    """
    head = rows.tid.to_numpy() < 0
    heads = rows[head].sort_values("gid")
    gid, block, floor = heads.gid.to_numpy(), heads.block.to_numpy(), heads.p.to_numpy()
    tids, column = np.unique(rows.tid.to_numpy()[~head], return_inverse=True)
    # The last column stands for all terms of the block that no source of the cell has.
    p = np.repeat(floor[:, None], len(tids) + 1, axis=1)
    p[np.searchsorted(gid, rows.gid.to_numpy()[~head]), column] = rows.p.to_numpy()[~head]
    times = np.ones(len(tids) + 1, dtype=np.int64)
    times[-1] = heads.slice_terms.iloc[0] - len(tids)
    i, j = rows.i.iloc[0], rows.j.iloc[0]
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    found = []
    for a in left:
        partners = right[right > a] if i == j else right
        gap = p[partners] - p[a]
        value = (gap * gap // (p[partners] + p[a])) @ times
        found.append(pd.DataFrame({"a": gid[a], "b": gid[partners], "value": value}))
    return pd.concat(found) if found else pd.DataFrame({"a": [], "b": [], "value": []}, dtype="int64")


def pair_divergences(groups: DataFrame, slices: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources of a language."""
    # A source takes part in the cells of its block with every block, itself included.
    facing = F.explode(F.expr("sequence(0, group_blocks - 1)"))
    cell = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    heads = (
        groups.join(slices, "lang")
        .withColumn("other", facing)
        .select("lang", *cell, "slice", "gid", "block", F.lit(-1).cast("long").alias("tid"), F.col("floor").alias("p"), "slice_terms")
    )
    bodies = counts.withColumn("other", facing).select("lang", *cell, "slice", "gid", "block", "tid", "p", F.lit(0).cast("long").alias("slice_terms"))
    parts = heads.unionByName(bodies).groupBy("lang", "i", "j", "slice").applyInPandas(cell_sums, "a long, b long, value long")
    sums = parts.groupBy("a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("own"), F.col("b").alias("theirs")), F.struct(F.col("b").alias("own"), F.col("a").alias("theirs"))))
    named = groups.select(F.col("gid").alias("own"), "lang", "source")
    others = groups.select(F.col("gid").alias("theirs"), F.col("source").alias("item"))
    return sums.select(both.alias("pair"), "value").select("pair.*", "value").join(named, "own").join(others, "theirs").select("lang", "source", "item", "value")


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK
) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of sources, and each source's top terms.

    The block sizes only say how the work is dealt out.
    """
    ship(docs.sparkSession)
    counted = stored(count_terms(docs, text, lang, source), "divergence-counts")
    spoken = counted.where(F.col("term").isNotNull())
    # Written, so that the numbers of terms and sources hold for all that follows.
    kept = spoken.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= MIN_DOCS)
    kept = stored(kept.select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("tid")), "divergence-terms")
    totals = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    langs = (
        counted.where(F.col("term").isNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(totals, "lang", "left").na.fill(0, ["terms", "lang_total"])
    )
    langs = langs.withColumns(
        {"group_blocks": F.ceil(F.col("sources") / group_block).cast("int"), "term_blocks": F.greatest(F.lit(1), F.ceil(F.col("terms") / term_block)).cast("int")}
    )
    langs = stored(langs, "divergence-langs")
    used = stored(spoken.drop("docs").join(kept, ["lang", "term"]), "divergence-used")
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counted.where(F.col("term").isNull()).select("lang", "source").join(sums, ["lang", "source"], "left").na.fill(0, ["total"]).join(langs, "lang")
    floor = F.when(F.col("terms") > 0, F.expr(f"1 + CAST(2 AS DECIMAL(20, 0)) * {SCALE} div nullif(total + 2 * terms, 0)")).otherwise(F.lit(1))
    groups = groups.select(
        "lang", "source", "total", "terms", "lang_total", "group_blocks", "term_blocks", floor.cast("long").alias("floor"),
        F.expr("pmod(xxhash64(source), group_blocks)").cast("int").alias("block"), F.monotonically_increasing_id().alias("gid"),
    )
    groups = stored(groups, "divergence-groups")
    counts = used.join(groups, ["lang", "source"]).withColumns(
        {"p": probability("n", "total", "terms"), "q": probability("lang_n", "lang_total", "terms"), "slice": F.expr("pmod(xxhash64(tid), term_blocks)").cast("int")}
    )
    own = F.struct("lang", F.expr("pmod(xxhash64(tid), term_blocks)").cast("int").alias("slice"))
    sizes = kept.join(langs, "lang").groupBy(own.alias("own")).agg(F.count(F.lit(1)).alias("slice_terms")).select("own.*", "slice_terms")
    every = langs.select("lang", F.explode(F.expr("sequence(0, term_blocks - 1)")).alias("slice"))
    slices = every.join(sizes, ["lang", "slice"], "left").na.fill(0, ["slice_terms"])
    pairs = ranked(pair_divergences(groups, slices, counts)).withColumn("part", F.lit("pair"))
    terms = counts.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), difference("p", "q").alias("value"))
    terms = ranked(terms).where(F.col("rank") <= TOP_TERMS).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
