from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from lakemart import contracts
from lakemart.operators import silver

RAW = {c: "string" for c in contracts.names(contracts.BRONZE_TRANSACTIONS)}


def raw_sale(spark, **changes):
    row = {
        "transaction_id": " t-7a ",
        "opportunity_name": "  Spring Deal ",
        "product_id": " p77 ",
        "store_id": "s9 ",
        "quantity": "4",
        "selling_price": "12.50",
        "discount_amount": "5.00",
        "transaction_timestamp": "17-Mar-2025 11.05.09 PM",
        "payment_mode": " Cash",
        "sales_channel": "Online ",
    } | changes
    return spark.createDataFrame([tuple(row[c] for c in RAW)], ", ".join(f"{c} string" for c in RAW))


def test_transaction_is_cleaned(spark):
    row = silver.transactions(raw_sale(spark)).head()
    assert (row.transaction_id, row.product_id, row.store_id) == ("T-7A", "P77", "S9")
    assert row.opportunity_name == "Spring Deal"
    assert row.quantity == 4
    assert (row.gross_amount, row.net_amount) == (Decimal("50.00"), Decimal("45.00"))
    assert row.transaction_timestamp == datetime(2025, 3, 17, 23, 5, 9)
    assert (row.payment_mode, row.sales_channel) == ("Cash", "Online")
    assert row.processed_at is not None


def test_midnight_and_noon(spark):
    for text, hour in (("01-Jan-2025 12.00.00 AM", 0), ("01-Jan-2025 12.00.00 PM", 12)):
        row = silver.transactions(raw_sale(spark, transaction_timestamp=text)).head()
        assert row.transaction_timestamp.hour == hour


def test_trim_removes_blanks_only(spark):
    assert silver.transactions(raw_sale(spark, payment_mode="\tCash ")).head().payment_mode == "\tCash"


def test_unreadable_values_become_null_and_are_named(spark):
    raw = raw_sale(spark, quantity="many", transaction_timestamp="yesterday", discount_amount=None)
    row = silver.transactions(raw, flag_failures=True).head()
    assert row.quantity is None and row.transaction_timestamp is None and row.net_amount is None
    assert row.parse_failures == ["quantity", "transaction_timestamp"]


def test_strict_mode_stops(spark):
    with pytest.raises(PySparkException):
        silver.transactions(raw_sale(spark, quantity="many"), strict=True).collect()


PRODUCT = (
    "product_id string, product_name string, category string, subcategory string, brand string, "
    "unit_price decimal(12,2), supplier_name string, launch_date date, __START_AT timestamp, "
    "__END_AT timestamp, updated_at timestamp"
)


@pytest.mark.parametrize(
    "price, segment",
    [("3000.00", "PREMIUM"), ("2999.99", "MID_RANGE"), ("500.00", "MID_RANGE"), ("499.99", "BUDGET"), (None, "BUDGET")],
)
def test_product_segment(spark, price, segment):
    day = datetime(2025, 1, 1)
    value = Decimal(price) if price else None
    row = (" p1", "GARDEN chair", "home", None, " acme CORP ", value, "bolt ltd", date(2024, 5, 1), day, None, day)
    out = silver.product_catalog(spark.createDataFrame([row], PRODUCT)).head()
    assert out.product_segment == segment
    assert (out.product_id, out.product_name, out.category) == ("P1", "Garden Chair", "Home")
    assert (out.subcategory, out.brand, out.supplier_name) == ("Unknown", "Acme Corp", "Bolt Ltd")
    assert out.is_active and out.start_at == day


def test_closed_version_is_inactive(spark):
    day = datetime(2025, 1, 1)
    row = ("p1", "a", "home", "x", "y", Decimal("1.00"), "s", None, day, datetime(2025, 2, 1), day)
    assert not silver.product_catalog(spark.createDataFrame([row], PRODUCT)).head().is_active


@pytest.mark.parametrize(
    "stock, reorder, status",
    [(0, 5, "OUT_OF_STOCK"), (5, 5, "LOW_STOCK"), (-1, 5, "LOW_STOCK"), (6, 5, "HEALTHY"), (None, 5, "HEALTHY")],
)
def test_inventory_status(spark, stock, reorder, status):
    rows = [(" i1 ", "p1", " s1", stock, reorder, " shelf ", datetime(2025, 1, 1))]
    out = silver.inventory(spark.createDataFrame(rows, contracts.BRONZE_INVENTORY)).head()
    assert (out.inventory_id, out.product_id, out.store_id) == ("I1", "P1", "S1")
    assert (out.inventory_status, out.warehouse_location) == (status, "shelf")


@pytest.mark.parametrize(
    "amount, size",
    [
        ("100000.01", "ENTERPRISE"),
        ("100000.00", "MID_MARKET"),
        ("25000.01", "MID_MARKET"),
        ("25000.00", "SMALL"),
        (None, "SMALL"),
    ],
)
def test_deal_size_and_untrimmed_text(spark, amount, size):
    names = contracts.names(contracts.BRONZE_OPPORTUNITY)
    values = dict.fromkeys(names) | {"Id": "o1", "Name": " Deal ", "Amount": Decimal(amount) if amount else None}
    frame = spark.createDataFrame([tuple(values[n] for n in names)], contracts.BRONZE_OPPORTUNITY)
    out = silver.opportunity(frame).head()
    assert (out.deal_size, out.name) == (size, " Deal ")


@pytest.mark.parametrize("industry, shown", [(None, "Unknown"), ("  ", ""), (" Toys ", "Toys")])
def test_account(spark, industry, shown):
    names = contracts.names(contracts.BRONZE_ACCOUNT)
    values = dict.fromkeys(names) | {
        "Id": " a1 ", "Name": " Shop ", "Industry": industry, "BillingCity": " Lyon", "ShippingPostalCode": "69001 ",
        "__START_AT": datetime(2025, 1, 1),
    }
    out = silver.account(spark.createDataFrame([tuple(values[n] for n in names)], contracts.BRONZE_ACCOUNT)).head()
    assert (out.id, out.customer_name, out.industry) == ("a1", "Shop", shown)
    assert (out.billing_city, out.shipping_postal_code, out.is_active) == ("Lyon", "69001", True)
