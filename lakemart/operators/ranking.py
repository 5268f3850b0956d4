"""Shares and ranks over whole results without funnelling rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share_of_total(df: DataFrame, measure: str, name: str = "share") -> DataFrame:
    """Each row's part of the column total, as a double.

    The total is a scalar subquery over the same aggregate; Spark reuses the
    aggregate's shuffle for it, so the input is read once.
    """
    total = df.agg(F.sum(measure).alias("t")).scalar()
    return df.withColumn(name, F.col(measure).cast("double") / total.cast("double"))


def _splits(df: DataFrame, measure: str, parts: int) -> list:
    """At most ``parts - 1`` values that cut the distinct measures evenly."""
    steps = [i / parts for i in range(1, parts)]
    cuts = df.agg(F.percentile_approx(F.col(measure), steps, F.lit(10_000)).alias("q")).head().q
    return sorted(set(cuts or []))


def rank_all(df: DataFrame, measure: str, name: str = "rank", parts: int = 64) -> DataFrame:
    """Descending ``rank()`` over all rows, computed range by range.

    Rank of a value = 1 + rows with a greater value.  The distinct values are
    counted, cut into ranges by ``parts - 1`` split values, summed within their
    range, and shifted by the number of rows in the ranges above (one line per
    range).  The splits decide only how even the work is, never the result.
    NULL ranks last, as in SQL with nulls last.
    """
    values = df.groupBy(measure).agg(F.count(F.lit(1)).alias("_n"))
    cuts = _splits(values, measure, parts)
    kind = df.schema[measure].dataType
    if cuts:
        edges = F.array(*(F.lit(c).cast(kind) for c in cuts))
        bucket: Column = F.size(F.filter(edges, lambda e: e < F.col(measure)))
        bucket = F.when(F.col(measure).isNull(), F.lit(-1)).otherwise(bucket)
    else:
        bucket = F.when(F.col(measure).isNull(), F.lit(-1)).otherwise(F.lit(0))
    ranged = values.withColumn("_range", bucket)

    above = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.sum("_n").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(above), F.lit(0)).alias("_offset"))
    )  # at most parts + 1 rows
    before = (
        Window.partitionBy("_range")
        .orderBy(F.col(measure).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = (
        ranged.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .join(F.broadcast(offsets), "_range")
        .select(F.col(measure).alias("_value"), (F.col("_offset") + F.col("_before") + 1).alias(name))
    )
    return df.join(ranks, df[measure].eqNullSafe(ranks["_value"])).drop("_value")
