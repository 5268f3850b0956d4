"""Checks between the layers: reports as DataFrames, gates that raise."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GateFailed(RuntimeError):
    """A pipeline-level failure: later stages must not run."""


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def reconcile(parts: dict[str, tuple[DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """(dataset, total, valid, quarantined) from separately counted tables."""
    counted = _stack(
        [
            frame.select(F.lit(dataset).alias("dataset"), F.lit(side).alias("side"))
            for dataset, frames in parts.items()
            for side, frame in zip(("total", "valid", "quarantined"), frames, strict=True)
        ]
    )
    # An explicit group per dataset, so that an empty one still gets its line.
    spark = counted.sparkSession
    named = spark.createDataFrame([(d,) for d in parts], "dataset string")
    sides = counted.groupBy("dataset").agg(
        *(F.count_if(F.col("side") == s).alias(s) for s in ("total", "valid", "quarantined"))
    )
    return named.join(sides, "dataset", "left").na.fill(0)


def require_reconciled(report: DataFrame) -> None:
    """Stop unless total = valid + quarantined for every dataset."""
    lost = report.filter(F.col("total") != F.col("valid") + F.col("quarantined")).collect()
    if lost:
        raise GateFailed("rows lost or doubled: " + ", ".join(map(str, lost)))


def key_violations(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows without a key, and rows beyond the first of each key."""
    counts = df.agg(
        F.count_if(F.col(key).isNull()).alias("missing"),
        (F.count(F.lit(1)) - F.countDistinct(key)).alias("repeated"),
    )
    return counts.select(
        F.stack(
            F.lit(2),
            F.lit(f"{table}.{key}_not_null"),
            F.col("missing"),
            F.lit(f"{table}.{key}_unique"),
            F.col("repeated"),
        ).alias("check_name", "violations")
    )


def dangling(fact: DataFrame, dim: DataFrame, key: str, check: str) -> DataFrame:
    """Fact rows whose key is set but not in the dimension.

    Counting per key first leaves one row per key to look up, however often a
    single key occurs in the fact.
    """
    used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return (
        used.join(dim.select(key), key, "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
        .select(F.lit(check).alias("check_name"), "violations")
    )


@dataclass(frozen=True)
class Star:
    """The four Gold tables.  Anything with these attributes will do."""

    fact_sales: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame


def gold_checks(star: Star) -> DataFrame:
    """The eleven checks of the star schema, one row each."""
    return _stack(
        [
            key_violations(star.fact_sales, "fact_sales", "transaction_id"),
            key_violations(star.dim_customer, "dim_customer", "customer_id"),
            key_violations(star.dim_product, "dim_product", "product_id"),
            key_violations(star.dim_date, "dim_date", "date_key"),
            dangling(star.fact_sales, star.dim_customer, "customer_id", "fact_sales.customer_fk"),
            dangling(star.fact_sales, star.dim_product, "product_id", "fact_sales.product_fk"),
            dangling(star.fact_sales, star.dim_date, "date_key", "fact_sales.date_fk"),
        ]
    )


def require_gold(report: DataFrame, allowed: int = 0) -> None:
    bad = report.filter(F.col("violations") > allowed).collect()
    if bad:
        raise GateFailed("gold checks failed: " + ", ".join(map(str, bad)))
