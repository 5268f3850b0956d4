from datetime import date
from decimal import Decimal

import pytest

from lakemart.operators import gates, security
from lakemart.plans import marts, semantics


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [("c1", "North", "111"), ("c2", "North", None), ("c3", "South", "333"), ("c4", None, "444")],
        "customer_id string, billing_state string, phone string",
    )


@pytest.fixture
def policy(spark):
    members = spark.createDataFrame([("ann", "admins"), ("bob", "staff")], "principal string, member_of string")
    return security.Policy(members, privileged=("rita",), open_region="North")


@pytest.mark.parametrize("who", ["ann", "rita"])
def test_privileged_reader_sees_all(customers, policy, who):
    out = security.secure_view(customers, policy, who).collect()
    assert {(r.customer_id, r.phone) for r in out} == {("c1", "111"), ("c2", None), ("c3", "333"), ("c4", "444")}


@pytest.mark.parametrize("who", ["bob", "unknown"])
def test_plain_reader_sees_open_region_masked(customers, policy, who):
    out = security.secure_view(customers, policy, who).collect()
    assert {(r.customer_id, r.phone) for r in out} == {("c1", "********"), ("c2", "********")}


def test_session_user_is_the_default(customers, policy):
    assert security.secure_view(customers, policy).count() == 2


@pytest.mark.parametrize("who", ["ann", "bob"])
def test_sql_functions_agree_with_the_view(spark, customers, policy, who):
    security.register_functions(spark, policy, who)
    out = spark.sql(
        "SELECT customer_id, billing_state, mask_customer_phone(phone) AS phone FROM {c} "
        "WHERE filter_customer_region(billing_state)",
        c=customers,
    )
    assert sorted(map(str, out.collect())) == sorted(map(str, security.secure_view(customers, policy, who).collect()))


def test_row_filter_reaches_the_scan(spark, customers, policy, tmp_path):
    customers.write.parquet(str(tmp_path / "c"))
    table = spark.read.parquet(str(tmp_path / "c"))
    plain = security.secure_view(table, policy, "bob")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(billing_state,North)" in plain
    admin = security.secure_view(table, policy, "ann")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in admin.replace("PushedFilters", "").replace("DataFilters", "").replace("PartitionFilters", "")


def test_visibility_agrees_with_the_views(spark, customers, policy):
    readers = ["ann", "bob", "rita", "unknown"]
    table = spark.createDataFrame([(r,) for r in readers], "principal string")
    out = {r.principal: r for r in security.visibility(customers, policy, table).collect()}
    for who in readers:
        view = security.secure_view(customers, policy, who)
        assert out[who].visible_rows == view.count()
        assert out[who].masked_phones == view.filter("phone = '********'").count()
        assert out[who].privileged == policy.is_privileged(who)


@pytest.fixture
def star(spark):
    D = Decimal
    fact = spark.createDataFrame(
        [
            ("t1", 20250115, "c1", "p1", 2, D("100.00"), "Card", "Online"),
            ("t2", 20250120, "c1", "p2", 1, D("50.00"), "Cash", "Store"),
            ("t3", 20250301, "c2", "p1", 1, D("30.00"), "Card", "Store"),
            ("t4", 20250302, "c9", "p9", 1, D("999.00"), "Card", "Store"),
        ],
        "transaction_id string, date_key int, customer_id string, product_id string, quantity int, "
        "net_sales_amount decimal(14,2), payment_mode string, sales_channel string",
    )
    customers = spark.createDataFrame(
        [("c1", "Ann", "Shop", "Toys", "North"), ("c2", "Bob", "Mall", "Food", "South")],
        "customer_id string, customer_name string, customer_type string, industry string, billing_state string",
    )
    products = spark.createDataFrame(
        [("p1", "Chair", "Home", "Acme", "BUDGET", "Bolt", "X"), ("p2", "Phone", "Mobile", "Acme", "PREMIUM", "Nut", "Y")],
        "product_id string, product_name string, category string, brand string, product_segment string, "
        "supplier_name string, subcategory string",
    )
    from lakemart.operators import gold

    return gates.Star(fact, customers, products, gold.dim_date(gold.date_spine(spark, date(2025, 1, 1), date(2025, 12, 31))))


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_monthly_sales_in_order(star):
    assert rows(marts.monthly_sales(star)) == [
        ("Jan 2025", 202501, Decimal("150.00")),
        ("Mar 2025", 202503, Decimal("1029.00")),
    ]


def test_change_over_the_month_before(star):
    out = rows(marts.sales_over_time(star))
    assert out[0][3:] == (None, None)
    assert out[1][3:] == (Decimal("879.00"), 5.86)


def test_top_customers(star):
    assert rows(marts.top_customers(star, 1)) == [("c1", "Ann", "Shop", Decimal("150.00"))]


def test_category_reports(star):
    assert rows(marts.sales_by_category(star)) == [("Home", Decimal("130.00")), ("Mobile", Decimal("50.00"))]
    assert {r[0]: r[2] for r in rows(marts.category_share(star))} == {"Home": 0.722222, "Mobile": 0.277778}
    assert [(r.product_id, r.sales_rank) for r in marts.product_rank(star).orderBy("sales_rank").collect()] == [
        ("p1", 1), ("p2", 2),
    ]
    assert sorted(rows(marts.supplier_sales(star))) == [
        ("Bolt", Decimal("130.00"), 3, 1), ("Nut", Decimal("50.00"), 1, 1),
    ]


def test_segments_and_channels(star):
    assert {r[:2]: r[3] for r in rows(marts.segment_mix(star))} == {("Shop", "Toys"): 1, ("Mall", "Food"): 1}
    assert {r[0]: r[1] for r in rows(marts.channel_share(star))} == {"Store": Decimal("1079.00"), "Online": Decimal("100.00")}


@pytest.mark.parametrize("word", ["Total Sales", "net sales", "Revenue", "total_net_sales", "sales  amount", "sales"])
def test_measure_synonyms(star, word):
    out = semantics.star_query(star, ["category"], word, filters={"sales_channel": "Store", "billing_state": ["North"]})
    assert rows(out) == [("Mobile", Decimal("50.00"))]


def test_only_needed_dimensions_are_joined(star):
    plan = semantics.star_query(star, ["payment_mode"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_unknown_words(star):
    with pytest.raises(KeyError):
        semantics.star_query(star, ["category"], "profit")
    with pytest.raises(KeyError):
        semantics.star_query(star, ["colour"])


def test_join_keys_must_be_unique(star):
    semantics.check_many_to_one(star)
    doubled = gates.Star(star.fact_sales, star.dim_customer.union(star.dim_customer), star.dim_product, star.dim_date)
    with pytest.raises(gates.GateFailed):
        semantics.check_many_to_one(doubled)


def test_entity_values(star):
    out = {(r.table_name, r.column_name, r.value): r.rows for r in semantics.entity_values(star).collect()}
    assert out["fact_sales", "payment_mode", "Card"] == 3
    assert out["dim_product", "brand", "Acme"] == 2
    assert out["dim_date", "month_name", "March"] == 31
