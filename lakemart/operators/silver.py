"""Bronze to Silver: one projection per dataset, valid for batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import (
    UNKNOWN,
    code,
    is_blank,
    ladder,
    moment,
    money,
    project,
    text,
    title,
    title_or_unknown,
    whole,
)

# Class limits and labels of the derived columns.
ENTERPRISE_ABOVE, MID_MARKET_ABOVE = 100000, 25000
PREMIUM_FROM, MID_RANGE_FROM = 3000, 500


def deal_size(amount: Column) -> Column:
    return ladder(
        [(amount > ENTERPRISE_ABOVE, "ENTERPRISE"), (amount > MID_MARKET_ABOVE, "MID_MARKET")],
        "SMALL",
    )


def product_segment(price: Column) -> Column:
    return ladder(
        [(price >= PREMIUM_FROM, "PREMIUM"), (price >= MID_RANGE_FROM, "MID_RANGE")],
        "BUDGET",
    )


def stock_status(stock: Column, reorder: Column) -> Column:
    return ladder([(stock == 0, "OUT_OF_STOCK"), (stock <= reorder, "LOW_STOCK")], "HEALTHY")


def _interval() -> dict[str, Column]:
    """Validity interval of a history row; the open one is the active one."""
    end = F.col("__END_AT")
    return {"start_at": F.col("__START_AT"), "end_at": end, "is_active": end.isNull()}


def transactions(raw: DataFrame, strict: bool = False, flag_failures: bool = False) -> DataFrame:
    """Clean point-of-sale rows and derive gross and net amounts.

    Unreadable values become NULL so that the quality rules can quarantine the
    row; ``strict=True`` stops the job on the first one instead.  With
    ``flag_failures`` the column ``parse_failures`` names every value that was
    given but could not be read, which :func:`quality.split` turns into errors.
    """
    quantity = whole("quantity", strict)
    price = money(F.col("selling_price"), 12, strict)
    discount = money(F.col("discount_amount"), 12, strict)
    when_sold = moment("transaction_timestamp", strict)
    gross = quantity * price

    extra = {}
    if flag_failures:
        parsed = {
            "quantity": quantity,
            "selling_price": price,
            "discount_amount": discount,
            "transaction_timestamp": when_sold,
        }
        failures = F.array_compact(
            F.array(
                *(
                    F.when(~is_blank(F.col(n)) & value.isNull(), F.lit(n))
                    for n, value in parsed.items()
                )
            )
        )
        if "_rescued_data" in raw.columns:
            # Values the ingest already could not fit into their column.
            lost = F.json_object_keys("_rescued_data")
            failures = F.array_union(failures, F.coalesce(lost, F.array().cast("array<string>")))
        extra["parse_failures"] = failures

    return project(
        raw,
        transaction_id=code("transaction_id"),
        opportunity_name=text("opportunity_name"),
        product_id=code("product_id"),
        store_id=code("store_id"),
        quantity=quantity,
        selling_price=price,
        gross_amount=money(gross, 14, strict),
        discount_amount=discount,
        net_amount=money(gross - discount, 14, strict),
        transaction_timestamp=when_sold,
        payment_mode=text("payment_mode"),
        sales_channel=text("sales_channel"),
        **extra,
        processed_at=F.current_timestamp(),
    )


# Silver name -> CRM name, for the text columns of an account.
ACCOUNT_ADDRESS = {
    f"{kind}_{part}": f"{kind.title()}{crm}"
    for kind in ("billing", "shipping")
    for part, crm in (
        ("street", "Street"),
        ("city", "City"),
        ("state", "State"),
        ("postal_code", "PostalCode"),
        ("country", "Country"),
    )
}


def account(history: DataFrame) -> DataFrame:
    """CRM account history with snake-case names and an active flag."""
    return project(
        history,
        id=text("Id"),
        is_deleted=F.col("IsDeleted"),
        customer_name=text("Name"),
        type=text("Type"),
        parent_id=F.col("ParentId"),
        **{name: text(crm) for name, crm in ACCOUNT_ADDRESS.items()},
        phone=text("Phone"),
        website=text("Website"),
        industry=F.coalesce(text("Industry"), F.lit(UNKNOWN)),
        annual_revenue=F.col("AnnualRevenue"),
        number_of_employees=F.col("NumberOfEmployees"),
        description=text("Description"),
        **_interval(),
        processed_at=F.current_timestamp(),
    )


def product_catalog(history: DataFrame) -> DataFrame:
    """Product history; the segment looks at the price before rounding."""
    price = F.col("unit_price")
    return project(
        history,
        product_id=code("product_id"),
        product_name=title("product_name"),
        category=title("category"),
        subcategory=title_or_unknown("subcategory"),
        brand=title_or_unknown("brand"),
        unit_price=F.round(price, 2),
        supplier_name=title("supplier_name"),
        launch_date=F.col("launch_date"),
        product_segment=product_segment(price),
        **_interval(),
        updated_at=F.col("updated_at"),
        processed_at=F.current_timestamp(),
    )


def inventory(rows: DataFrame) -> DataFrame:
    stock, reorder = F.col("stock_quantity"), F.col("reorder_level")
    return project(
        rows,
        inventory_id=code("inventory_id"),
        product_id=code("product_id"),
        store_id=code("store_id"),
        stock_quantity=stock,
        reorder_level=reorder,
        inventory_status=stock_status(stock, reorder),
        warehouse_location=text("warehouse_location"),
        last_stock_update=F.col("last_stock_update"),
        processed_at=F.current_timestamp(),
    )


# Silver name -> CRM name; deals keep their text as the CRM wrote it.
OPPORTUNITY_BEFORE = {
    "id": "Id",
    "is_deleted": "IsDeleted",
    "account_id": "AccountId",
    "name": "Name",
    "description": "Description",
    "stage_name": "StageName",
}
OPPORTUNITY_AFTER = {
    "probability": "Probability",
    "close_date": "CloseDate",
    "type": "Type",
    "next_step": "NextStep",
    "lead_source": "LeadSource",
    "is_closed": "IsClosed",
    "is_won": "IsWon",
    "forecast_category": "ForecastCategory",
    "owner_id": "OwnerId",
    "created_date": "CreatedDate",
    "last_modified_date": "LastModifiedDate",
}


def opportunity(rows: DataFrame, strict: bool = False) -> DataFrame:
    amount = money(F.col("Amount"), 18, strict)
    return project(
        rows,
        **{name: F.col(crm) for name, crm in OPPORTUNITY_BEFORE.items()},
        amount=amount,
        deal_size=deal_size(amount),
        **{name: F.col(crm) for name, crm in OPPORTUNITY_AFTER.items()},
    )


BUILDERS = {
    "transactions": transactions,
    "opportunity": opportunity,
    "inventory": inventory,
    "product_catalog": product_catalog,
    "account": account,
}
