"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces.

Sections are separated by an empty line, paragraphs are lines, and a paragraph
falls into pieces that end with a sentence or after 160 characters.  Every node
is the SHA-256 of its children's digests, so two roots are equal exactly if the
texts are; where they differ, unequal branches lead to the edit.

The fingerprint is one string: ``root|section=paragraph:piece,piece;...|...``
with shortened digests below the root.  The likeness of two fingerprints is the
Jaccard similarity of their distinct pieces (1 for equal roots).

NULL text counts as empty: one section with one paragraph without pieces.
Repeated rows have equal fingerprints.  Empty table: no rows.  Columns of the
input with the result's names are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import stored, text_of

PIECE = r"[^.!?]{1,160}[.!?]*|[.!?]+"
SHORT = 12  # hex digits of a digest below the root
BLOCK = 256  # ids to a block
BLOCKS = 4096  # blocks to a group of blocks
FIRST = -(1 << 62)  # block of rows without id


def _digest(children: Column) -> Column:
    return F.sha2(F.array_join(children, ","), 256)


def fingerprint(text: Column) -> Column:
    """The fingerprint string of a text."""

    def paragraph(line: Column) -> Column:
        pieces = F.transform(F.regexp_extract_all(line, F.lit(PIECE), F.lit(0)), lambda p: F.sha2(p, 256))
        short = F.array_join(F.transform(pieces, lambda d: F.substring(d, 1, SHORT)), ",")
        return F.struct(_digest(pieces).alias("digest"), short.alias("pieces"))

    def section(block: Column) -> Column:
        lines = F.transform(F.split(block, "\n"), paragraph)
        shown = F.transform(lines, lambda p: F.concat(F.substring(p["digest"], 1, SHORT), F.lit(":"), p["pieces"]))
        return F.struct(_digest(F.transform(lines, lambda p: p["digest"])).alias("digest"), F.array_join(shown, ";").alias("shown"))

    sections = F.transform(F.split(text, "\n\n"), section)
    parts = F.transform(sections, lambda s: F.concat(F.substring(s["digest"], 1, SHORT), F.lit("="), s["shown"]))
    return F.concat(_digest(F.transform(sections, lambda s: s["digest"])), F.lit("|"), F.array_join(parts, "|"))


def root(print_: Column) -> Column:
    return F.substring_index(print_, "|", 1)


def sections(print_: Column) -> Column:
    """The sections of a fingerprint, digest and paragraphs together."""
    parts = F.split(print_, r"\|")
    return F.slice(parts, 2, F.size(parts) - 1)


def pieces(print_: Column) -> Column:
    """All piece digests of a fingerprint: what stands behind a colon or comma."""
    return F.regexp_extract_all(print_, F.lit("[:,]([0-9a-f]{%d})" % SHORT), F.lit(1))


def likeness(a: Column, b: Column) -> Column:
    """Share of the distinct pieces of two fingerprints that both have (0 to 1)."""
    either = F.size(F.array_union(pieces(a), pieces(b)))
    both = F.size(F.array_intersect(pieces(a), pieces(b)))
    return F.when(root(a) == root(b), F.lit(1.0)).when(either == 0, F.lit(0.0)).otherwise(both / either)


def edits(a: Column, b: Column) -> Column:
    """(section, paragraph, piece), counted from 1, where the two trees differ.

    Equal branches are not entered.  A place that only one tree has counts.
    """

    def places(x: Column, y: Column) -> Column:
        most = F.greatest(F.size(x), F.size(y))
        at = F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))
        return F.filter(at, lambda i: ~F.get(x, i - 1).eqNullSafe(F.get(y, i - 1)))

    def lines(section: Column) -> Column:
        return F.split(F.coalesce(F.split_part(section, F.lit("="), F.lit(2)), F.lit("")), ";")

    def leaves(line: Column) -> Column:
        return F.filter(F.split(F.coalesce(F.split_part(line, F.lit(":"), F.lit(2)), F.lit("")), ","), lambda p: p != "")

    sa, sb = sections(a), sections(b)

    def in_section(i: Column) -> Column:
        la, lb = lines(F.get(sa, i - 1)), lines(F.get(sb, i - 1))

        def in_line(j: Column) -> Column:
            wrong = places(leaves(F.get(la, j - 1)), leaves(F.get(lb, j - 1)))
            return F.transform(wrong, lambda k: F.struct(i.alias("section"), j.alias("paragraph"), k.alias("piece")))

        return F.flatten(F.transform(places(la, lb), in_line))

    found = F.flatten(F.transform(places(sa, sb), in_section))
    return F.when(root(a) != root(b), found).otherwise(F.filter(found, lambda _: F.lit(False)))


def fingerprints(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The keys with the fingerprint of every whole text."""
    return docs.select(*keys, fingerprint(text_of(text)).alias("fingerprint"))


def with_next_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, next_text): the text of the next id, of the first one after the last.

    Rows are ordered within blocks of ids.  The first row of each block also
    serves the block before; equal ids go by the text's hash.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("doc_id") / BLOCK), F.lit(FIRST)).cast("long"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    heads = rows.groupBy("block").agg(F.min(F.struct("doc_id", "tie")).alias("head"))
    # The block in front of each block: within groups of blocks, then across their borders.
    grouped = heads.withColumn("lot", F.floor(F.col("block") / BLOCKS))
    inside = grouped.withColumn("before", F.lag("block").over(Window.partitionBy("lot").orderBy("block")))
    lots = inside.groupBy("lot").agg(F.max("block").alias("last"))
    around = Window.orderBy("lot").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lots = lots.select(
        F.col("lot").alias("l"), F.coalesce(F.lag("last").over(Window.orderBy("lot")), F.max("last").over(around)).alias("wrap")
    )
    heads = inside.join(lots, F.col("lot") == F.col("l")).select(
        F.col("block").alias("b"), "head", F.coalesce("before", "wrap").alias("before")
    )
    # One row per block, written so that its size is known: small, it travels to the texts.
    heads = stored(heads, "merkle-heads")
    same = (F.col("block") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("tie") == F.col("head.tie"))
    firsts = rows.join(heads, same).dropDuplicates(["block"]).select(F.col("before").alias("for_block"), F.col("text").alias("first_text"))
    order = Window.partitionBy("block").orderBy("doc_id", "tie")
    led = rows.withColumn("next_text", F.lead("text").over(order))
    at_end = F.col("next_text").isNull() & (F.col("block") == F.col("for_block"))
    return led.join(firsts, at_end, "left").select("doc_id", "text", F.coalesce("next_text", "first_text").alias("next_text"))


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text against itself with its last quarter replaced by the next text's start, and against the next text."""
    rows = with_next_text(docs, doc_id, text).withColumn("n_chars", F.length("text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - quarter), F.substring("next_text", F.lit(1), quarter))
    printed = rows.withColumn("edited", edited).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        fingerprint(F.col("next_text")).alias("next_fingerprint"),
    )
    return printed.select(
        F.col("doc_id").alias(doc_id),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
