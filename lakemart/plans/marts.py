"""Ready-made sales reports over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.operators.gates import Star
from lakemart.operators.ranking import rank_all, share_of_total
from lakemart.plans.semantics import star_query
from lakemart.sources.tables import materialize

TOTAL = "total_net_sales"


def monthly_sales(star: Star) -> DataFrame:
    by_month = star_query(star, ["month_year_sort", "month_year"], order="dims")
    return by_month.select(
        F.col("month_year").alias("month"), F.col("month_year_sort").alias("month_sort"), TOTAL
    )


def top_customers(star: Star, k: int = 10) -> DataFrame:
    return star_query(star, ["customer_id", "customer_name", "customer_type"], limit=k)


def sales_by_category(star: Star) -> DataFrame:
    return star_query(star, ["category"])


def sales_over_time(star: Star) -> DataFrame:
    """Monthly sales with the change from the month before.

    The window is not partitioned: its rows are months of the calendar.
    """
    month = Window.orderBy("month_sort")
    before = F.lag(TOTAL).over(month)
    change = (F.col(TOTAL) - before).cast("double")
    return monthly_sales(star).select(
        "month",
        "month_sort",
        TOTAL,
        (F.col(TOTAL) - before).alias("change"),
        F.round(change / before.cast("double"), 6).alias("change_ratio"),
    )


def category_share(star: Star) -> DataFrame:
    out = share_of_total(star_query(star, ["category"], order=None), TOTAL)
    return out.withColumn("share", F.round("share", 6))


def product_rank(star: Star) -> DataFrame:
    """Every sold product with its place by net sales."""
    # Ranking looks at the totals several times: write them once.
    sold = materialize(star_query(star, ["product_id", "product_name"], order=None), "product-totals")
    return rank_all(sold, TOTAL, "sales_rank")


def supplier_sales(star: Star) -> DataFrame:
    """Sales, units and number of sold products per supplier."""
    per_product = star.fact_sales.groupBy("product_id").agg(
        F.sum("net_sales_amount").alias("_sales"), F.sum("quantity").alias("_units")
    )
    suppliers = star.dim_product.select("product_id", "supplier_name")
    return (
        per_product.join(suppliers, "product_id")
        .groupBy("supplier_name")
        .agg(
            F.sum("_sales").alias(TOTAL),
            F.sum("_units").alias("units_sold"),
            F.count("product_id").alias("products_sold"),
        )
    )


def segment_mix(star: Star) -> DataFrame:
    """Sales and buying customers per customer type and industry."""
    per_customer = star.fact_sales.groupBy("customer_id").agg(F.sum("net_sales_amount").alias("_sales"))
    segments = star.dim_customer.select("customer_id", "customer_type", "industry")
    mix = (
        per_customer.join(segments, "customer_id")
        .groupBy("customer_type", "industry")
        .agg(F.sum("_sales").alias(TOTAL), F.count("customer_id").alias("customers"))
    )
    out = share_of_total(mix, TOTAL)
    return out.withColumn("share", F.round("share", 6))


def channel_share(star: Star) -> DataFrame:
    out = share_of_total(star_query(star, ["sales_channel"]), TOTAL)
    return out.withColumn("share", F.round("share", 6))
