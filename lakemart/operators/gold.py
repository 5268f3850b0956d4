"""Silver to Gold: the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.contracts import DIM_CUSTOMER, DIM_PRODUCT, names
from lakemart.functions.columns import conform, date_key, match_key, project
from lakemart.operators.skew import salted_left_join

# The default calendar.
CALENDAR_START, CALENDAR_END = date(2024, 1, 1), date(2030, 12, 31)


def dim_customer(accounts: DataFrame) -> DataFrame:
    """Active customers; a row with unknown deletion state is left out."""
    current = accounts.filter(F.col("is_active") & ~F.col("is_deleted"))
    renamed = current.withColumnsRenamed({"id": "customer_id", "type": "customer_type"})
    return conform(renamed, DIM_CUSTOMER)


def dim_product(products: DataFrame) -> DataFrame:
    return products.where("is_active").select(*names(DIM_PRODUCT))


def date_spine(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    """One row per day, both ends included, made in parallel."""
    days = (end - start).days + 1
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))


def date_spine_covering(df: DataFrame, column: str) -> DataFrame:
    """One row per day of all years that ``column`` touches."""
    first, last = F.min(column).cast("date"), F.max(column).cast("date")
    years = df.agg(
        F.trunc(first, "year").alias("start"),
        F.date_sub(F.add_months(F.trunc(last, "year"), 12), 1).alias("end"),
    )
    return years.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("full_date"))


def calendar_columns(day: Column) -> dict[str, Column]:
    """Every column of the calendar as a function of the day."""
    weekday: Column = F.dayofweek(day)  # 1 = Sunday
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_year": F.date_format(day, "MMM yyyy"),
        "month_year_sort": F.year(day) * 100 + F.month(day),
        "month_start": F.trunc(day, "month"),
        "week_of_year": F.weekofyear(day),
        "day": F.dayofmonth(day),
        "day_name": F.date_format(day, "EEEE"),
        "day_of_week_sort": F.weekday(day) + 1,  # Monday 1 ... Sunday 7
        "is_weekend": weekday.isin(1, 7),
    }


def dim_date(spine: DataFrame) -> DataFrame:
    return project(spine, **calendar_columns(F.col("full_date")))


def day_of_key(key: Column) -> Column:
    """The day that a date key stands for."""
    return F.to_date(key.cast("string"), "yyyyMMdd")


def fact_sales(
    transactions: DataFrame, opportunities: DataFrame, heavy: DataFrame | None = None
) -> DataFrame:
    """One row per sale, with its customer found through the deal's name.

    Names match without case or outer blanks.  Sales without a name, and those
    whose name is in ``heavy`` (``heavy_keys`` of the same key), are spread
    over the cluster; adaptive execution looks after the others.
    """
    deals = opportunities.select(F.col("name").alias("_deal"), F.col("account_id").alias("customer_id"))
    joined = salted_left_join(
        transactions,
        deals,
        match_key("opportunity_name"),
        match_key("_deal"),
        ["transaction_id"],
        heavy,
    )
    return project(
        joined,
        transaction_id=F.col("transaction_id"),
        date_key=date_key(F.col("transaction_timestamp")),
        customer_id=F.col("customer_id"),
        product_id=F.col("product_id"),
        store_id=F.col("store_id"),
        quantity=F.col("quantity"),
        selling_price=F.col("selling_price"),
        discount_amount=F.col("discount_amount"),
        net_sales_amount=F.col("net_amount"),
        payment_mode=F.col("payment_mode"),
        sales_channel=F.col("sales_channel"),
    )
