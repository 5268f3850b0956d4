"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A broadcast side beyond this many rows is not broadcast by hand.
BROADCAST_ROWS = 100_000


def is_bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only if it was counted to be small.

    A larger one is returned unmarked: the join then shuffles, and adaptive
    execution splits its skewed partitions.
    """
    return F.broadcast(df) if is_bounded(df, max_rows) else df


def heavy_keys(df: DataFrame, key: Column, parts: int = 200) -> DataFrame:
    """Keys with more than 1/``parts`` of all rows: fewer than ``parts`` of them.

    The count combines on the map side, so the heavy keys themselves do not
    skew it.
    """
    counts = df.select(key.alias("_key")).filter("_key IS NOT NULL").groupBy("_key").count()
    total = counts.agg(F.sum("count")).scalar()
    return counts.filter(F.col("count") * parts > total).select("_key")


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: Column,
    spread_by: Sequence[str],
    heavy: DataFrame | None = None,
    salts: int = 64,
) -> DataFrame:
    """Left join on one key whose rows may be very unevenly spread.

    Rows with a NULL key never match; a salt spreads them over all partitions
    instead of one.  Rows with a key in ``heavy`` (see :func:`heavy_keys`, its
    size is bounded) are spread too, and the right rows of just these keys are
    repeated once per salt.  Every left row meets every matching right row
    exactly once, so the result is that of the plain join.
    """
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    lhs = left.withColumn("_key", left_key)
    rhs = right.withColumn("_key", right_key).filter("_key IS NOT NULL")
    spread, copies = F.col("_key").isNull(), F.array(F.lit(0))
    if heavy is not None:
        flagged = F.broadcast(heavy.withColumn("_heavy", F.lit(True)))
        lhs = lhs.join(flagged, "_key", "left")
        rhs = rhs.join(flagged, "_key", "left")
        spread = spread | F.col("_heavy").isNotNull()
        copies = F.when(F.col("_heavy").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(copies)
    lhs = lhs.withColumn("_salt", F.when(spread, salt).otherwise(F.lit(0))).drop("_heavy")
    rhs = rhs.withColumn("_salt", F.explode(copies)).drop("_heavy")
    return lhs.join(rhs, ["_key", "_salt"], "left").drop("_key", "_salt")
