"""Mixing sources to target weights by exponential keys.

Each source gets a target in words.  A target of one source size or more takes
the whole source that many times; the rest is selected by Efraimidis-Spirakis
keys, an exponential draw divided by the document's quality weight: the smallest
keys up to the budget, the last document in part.

The order within a source is never laid out as one sort.  Keys fall into
logarithmic buckets; sums per source and bucket show the one bucket in which the
budget ends, and only its rows are sorted.

NULL or empty text: size 0, nothing taken.  NULL source: a source of its own,
ordered last.  Repeated rows each count; equal keys go by id, size and text.
Empty table: no rows.  Columns of the input with the result's names are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import WORD, bucket_hash, set_aside, stored, text_of

SOURCE_WEIGHTS = (5, 2, 1)
PER_OCTAVE = 1024
LEAST_WEIGHT = 1e-6  # stands in for missing weights and those below it
RESULT = ("size", "source_size", "target", "taken")


def words_in(text: str) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def quality_weight(text: str, size: Column) -> Column:
    """Weight of a document in (0, 1]: few symbols, not too short."""
    plain = F.length(F.translate(text_of(text), "#*$%&|<>", ""))
    chars = F.length(text_of(text))
    symbols = F.when(chars > 0, (chars - plain) / chars).otherwise(F.lit(0.0))
    return (F.lit(1.0) - F.lit(0.9) * F.least(F.lit(1.0), F.lit(10.0) * symbols)) * F.when(size < 50, F.lit(0.5)).otherwise(
        F.lit(1.0)
    )


def measured(docs: DataFrame, doc_id: str, source: str, text: str, seed: str, weight: Column | None) -> DataFrame:
    """The rows with size, key and bucket of the key."""
    sized = docs.drop(*(c for c in RESULT if c in docs.columns)).withColumn("size", words_in(text))
    chosen = weight if weight is not None else quality_weight(text, F.col("size"))
    keyed = sized.withColumns(
        {
            "__draw": bucket_hash(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) + F.lit(2.0**-54),
            "__weight": F.greatest(F.coalesce(chosen, F.lit(LEAST_WEIGHT)), F.lit(LEAST_WEIGHT)),
            "__tie": F.xxhash64(text_of(text)),
        }
    )
    keyed = keyed.withColumn("__key", -F.log(F.col("__draw")) / F.col("__weight"))
    return keyed.withColumn("__bucket", F.floor(F.log2("__key") * PER_OCTAVE)).drop("__draw", "__weight")


def targets(sizes: DataFrame, source: str, share: float, most: float) -> DataFrame:
    """Target of each source: filled up by weight, none above ``most`` times its size.

    A source is full if its limit per weight lies below the level that remains
    once all sources with lower limits are full.
    """
    rank = Window.orderBy(F.col(source).asc_nulls_last())
    weights = F.array(*map(F.lit, SOURCE_WEIGHTS))
    ranked = sizes.withColumn("__rank", F.row_number().over(rank) - 1)
    weighted = ranked.withColumn("__w", F.element_at(weights, (F.col("__rank") % len(SOURCE_WEIGHTS) + 1).cast("int")))
    limit = F.lit(most) * F.col("source_size")
    filling = Window.orderBy("__limit", "__rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("__limit", "__rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.lit(share) * F.sum("source_size").over(everything) - (F.sum("__cap").over(filling) - F.col("__cap"))
    ) / (F.sum("__w").over(everything) - (F.sum("__w").over(filling) - F.col("__w")))
    levelled = (
        weighted.withColumn("__cap", limit)
        .withColumn("__limit", F.col("__cap") / F.col("__w"))
        .withColumn("__level", level)
        .withColumn("__full", F.col("__limit") < F.col("__level"))
    )
    shared = F.max(F.when(~F.col("__full"), F.col("__level"))).over(everything)
    return levelled.withColumn("__shared", shared).select(
        source, "source_size", F.when(F.col("__full"), F.col("__cap")).otherwise(F.col("__w") * F.col("__shared")).alias("target")
    )


def budgets(rows: DataFrame, source: str, share: float, most: float) -> DataFrame:
    """Per source: size, target, whole epochs, and the bucket in which the rest ends."""
    sums = stored(rows.groupBy(source, "__bucket").agg(F.sum("size").alias("__words")), "mix-buckets")
    sizes = sums.groupBy(source).agg(F.sum("__words").alias("source_size"))
    goal = targets(sizes, source, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goal = goal.withColumn("__epochs", epochs.cast("long")).withColumn(
        "__budget", F.floor(F.col("target") - F.col("__epochs") * F.col("source_size")).cast("long")
    )
    reached = F.sum("__words").over(Window.partitionBy(source).orderBy("__bucket"))
    steps = sums.withColumn("__reached", reached).select(F.col(source).alias("__s"), "__bucket", "__words", "__reached")
    ends = (
        goal.join(steps, F.col(source).eqNullSafe(F.col("__s")) & (F.col("__reached") >= F.col("__budget")), "left")
        .groupBy(source, "source_size", "target", "__epochs", "__budget")
        .agg(
            F.min("__bucket").alias("__end"),
            F.min_by(F.col("__reached") - F.col("__words"), F.col("__bucket")).alias("__before"),
        )
    )
    return ends.select(F.col(source).alias("__s"), "source_size", "target", "__epochs", "__budget", "__end", "__before")


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix-1",
    weight: Column | None = None,
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """Rows with size, source_size, target and taken (words that the mix takes).

    ``carry`` names the input columns to return, all if None.
    """
    given = docs.columns if carry is None else carry
    named, back = set_aside(docs)
    other = dict(zip(docs.columns, named.columns))
    docs, columns = named, [other[c] for c in given if c not in RESULT]
    needed = list(dict.fromkeys([*columns, doc_id, source]))
    hidden = ["__key", "__bucket", "__tie"]
    rows = stored(measured(docs, doc_id, source, text, seed, weight).select(*needed, "size", *hidden), "mix-sizes")
    plan = stored(budgets(rows, source, share, most), "mix-plan")
    joined = rows.join(plan, F.col(source).eqNullSafe(F.col("__s")))
    whole = F.col("__epochs") * F.col("size")
    # Only where the budget ends does the order within a bucket matter.
    decided = joined.where(F.col("__bucket") != F.col("__end")).withColumn(
        "taken", whole + F.when(F.col("__bucket") < F.col("__end"), F.col("size")).otherwise(F.lit(0))
    )
    order = Window.partitionBy(source).orderBy("__key", doc_id, "size", "__tie")
    ahead = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("__budget") - F.col("__before") - ahead))
    border = joined.where(F.col("__bucket") == F.col("__end")).withColumn("taken", whole + part)
    return back(decided.unionByName(border).select(*columns, "size", "source_size", "target", F.col("taken").cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix as documents: whole copies, and the part of a document that is taken in part.

    The part keeps its first words, joined by one space.
    """
    docs, back = set_aside(docs)
    mixed = mix(docs, text=text, **options)
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(F.lit(0))
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(0))
    words = F.slice(F.regexp_extract_all(text_of(text), F.lit(WORD), 0), 1, rest.cast("int"))
    wanted = F.concat(
        F.array_repeat(F.lit(False), copies.cast("int")), F.when(rest > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    )
    dealt = mixed.withColumn("__part", F.explode(wanted))
    dealt = dealt.withColumn(text, F.when(F.col("__part"), F.array_join(words, " ")).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        dealt = dealt.withColumn("n_chars", F.length(text_of(text)).cast(docs.schema["n_chars"].dataType))
    return back(dealt.select(*docs.columns))
