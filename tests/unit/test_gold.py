from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart import contracts
from lakemart.operators import gold, ranking, skew

SALES = (
    "transaction_id string, opportunity_name string, product_id string, store_id string, quantity int, "
    "selling_price decimal(12,2), discount_amount decimal(12,2), net_amount decimal(14,2), "
    "transaction_timestamp timestamp, payment_mode string, sales_channel string"
)


def sale(tid, name):
    return (
        tid, name, "P1", "S1", 3, Decimal("20.00"), Decimal("6.00"), Decimal("54.00"),
        datetime(2025, 12, 31, 8), "Cash", "Store",
    )


def test_names_match_without_case_and_blanks(spark):
    sales = spark.createDataFrame([sale("T1", " BIG deal"), sale("T2", None), sale("T3", "other"), sale("T4", "")], SALES)
    deals = spark.createDataFrame([("big DEAL ", "C1"), (None, "C2"), ("x", "C3")], "name string, account_id string")
    out = {r.transaction_id: r for r in gold.fact_sales(sales, deals).collect()}
    assert {t: r.customer_id for t, r in out.items()} == {"T1": "C1", "T2": None, "T3": None, "T4": None}
    assert out["T1"].date_key == 20251231 and out["T1"].net_sales_amount == Decimal("54.00")
    assert tuple(gold.fact_sales(sales, deals).columns) == contracts.names(contracts.FACT_SALES)


def test_equal_names_fan_out_as_a_join_does(spark):
    sales = spark.createDataFrame([sale("T1", "d")], SALES)
    deals = spark.createDataFrame([("d", "C1"), (" D", "C2")], "name string, account_id string")
    assert {r.customer_id for r in gold.fact_sales(sales, deals).collect()} == {"C1", "C2"}


def test_heavy_keys_and_salted_join(spark):
    left = spark.range(3000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else concat('k', id % 50) end as k"
    )
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k2", 3), ("k7", 4), (None, 5)], "rk string, v int")
    heavy = skew.heavy_keys(left, F.col("k"), parts=10)
    assert [r[0] for r in heavy.collect()] == ["hot"]
    plain = left.join(right, left.k == right.rk, "left")
    for given in (None, heavy):
        salted = skew.salted_left_join(left, right, F.col("k"), F.col("rk"), ["id"], given, salts=8)
        assert salted.columns == plain.columns
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_null_keys_are_spread(spark):
    left = spark.range(1000).selectExpr("id", "if(id = 999, 'a', null) as k")
    right = spark.createDataFrame([("a", 1)], "rk string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.salted_left_join(left, right, F.col("k"), F.col("rk"), ["id"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_key" in plan and "_salt" in plan.split("hashpartitioning(_key")[1].split(")")[0]
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_calendar(spark):
    days = gold.dim_date(gold.date_spine(spark))
    assert days.count() == 2557
    assert tuple(days.columns) == contracts.names(contracts.DIM_DATE)
    at = {r.full_date: r for r in days.filter("full_date in ('2024-02-29', '2027-01-03', '2027-01-04')").collect()}
    leap, sunday, monday = at[date(2024, 2, 29)], at[date(2027, 1, 3)], at[date(2027, 1, 4)]
    assert (leap.date_key, leap.month_year, leap.month_year_sort, leap.quarter_name) == (20240229, "Feb 2024", 202402, "Q1")
    assert (leap.month_start, leap.month_name, leap.day_name) == (date(2024, 2, 1), "February", "Thursday")
    assert (sunday.day_of_week_sort, sunday.is_weekend, sunday.week_of_year) == (7, True, 53)
    assert (monday.day_of_week_sort, monday.is_weekend, monday.week_of_year) == (1, False, 1)


def test_calendar_covers_the_data(spark):
    df = spark.createDataFrame([(datetime(2024, 5, 1),), (datetime(2025, 12, 31, 23),), (None,)], "at timestamp")
    spine = [r.full_date for r in gold.date_spine_covering(df, "at").collect()]
    assert (min(spine), max(spine), len(spine)) == (date(2024, 1, 1), date(2025, 12, 31), 731)


def test_dim_customer(spark):
    names = (
        "id", "is_deleted", "customer_name", "type", "billing_city", "billing_state", "billing_country", "phone",
        "website", "industry", "annual_revenue", "number_of_employees", "description", "is_active",
    )
    kinds = dict.fromkeys(names, "string") | {
        "is_deleted": "boolean", "is_active": "boolean", "annual_revenue": "decimal(18,2)", "number_of_employees": "int",
    }
    rows = [
        {"id": "a", "is_deleted": False, "is_active": True, "annual_revenue": Decimal("5.00")},
        {"id": "b", "is_deleted": True, "is_active": True},
        {"id": "c", "is_deleted": None, "is_active": True},
        {"id": "d", "is_deleted": False, "is_active": False},
    ]
    ddl = ", ".join(f"{n} {kinds[n]}" for n in names)
    out = gold.dim_customer(spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl))
    assert [r.customer_id for r in out.collect()] == ["a"]
    assert dict(out.dtypes)["annual_revenue"] == "decimal(38,20)"
    with pytest.raises(ValueError):
        gold.dim_customer(spark.createDataFrame([(True, False)], "is_active boolean, is_deleted boolean"))


def test_rank_all_matches_window(spark):
    from pyspark.sql import Window

    # A third of the rows share one value.
    df = spark.range(900).selectExpr("id", "cast(if(id % 3 = 0, 7, (id * 37) % 200) as decimal(10,2)) as v")
    df = df.unionByName(spark.createDataFrame([(1000, None)], "id bigint, v decimal(10,2)"))
    want = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    got = ranking.rank_all(df, "v", "r", parts=5)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_share(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    assert {r.k: r.share for r in ranking.share_of_total(df, "v").collect()} == {"a": 0.25, "b": 0.75}
