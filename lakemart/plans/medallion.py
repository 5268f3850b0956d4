"""The layers composed lazily over a Bronze provider."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame

from lakemart.operators import cdc, gold, quality, silver
from lakemart.sources.tables import pieces

# The order in which repeated sales are told apart, oldest first, then every value.
SALES_ORDER = (
    "transaction_timestamp", "opportunity_name", "product_id", "store_id",
    "quantity", "selling_price", "discount_amount", "payment_mode", "sales_channel",
)
# Columns whose change makes a new product version.
PRODUCT_TRACK = (
    "product_name", "category", "subcategory", "brand",
    "unit_price", "supplier_name", "launch_date",
)


class Medallion:
    """Silver, valid, quarantine and Gold as unevaluated DataFrames.

    ``bronze`` offers ``transactions``, ``opportunity``, ``account_feed``,
    ``product_feed`` and ``inventory_feed``.  Without ``start`` and ``end`` the
    calendar covers all years of the sales, so that no sale falls out of a report.
    """

    def __init__(
        self,
        bronze,
        start: date | None = None,
        end: date | None = None,
        flag_failures: bool = False,
    ):
        self.bronze = bronze
        self.flag_failures = flag_failures
        self.spark = bronze.spark
        self.start, self.end = start, end

    @property
    def calendar_follows_sales(self) -> bool:
        """Without fixed ends the calendar has every day that a sale can have."""
        return not (self.start and self.end)

    # ------------------------------------------------------------ bronze
    @cached_property
    def account_history(self) -> DataFrame:
        return cdc.history(self.bronze.account_feed(), ["Id"])

    @cached_property
    def product_history(self) -> DataFrame:
        return cdc.history(self.bronze.product_feed(), ["product_id"], track=PRODUCT_TRACK)

    @cached_property
    def inventory_current(self) -> DataFrame:
        feed = self.bronze.inventory_feed()
        return cdc.current_state(feed, ["inventory_id"], pieces=pieces(feed))

    # ------------------------------------------------------------ silver
    @cached_property
    def cleaned_transactions(self) -> DataFrame:
        """Before deduplication."""
        return silver.transactions(self.bronze.transactions(), flag_failures=self.flag_failures)

    @cached_property
    def silver_transactions(self) -> DataFrame:
        cleaned = self.cleaned_transactions
        return cdc.deduplicate(cleaned, "transaction_id", SALES_ORDER, pieces=pieces(cleaned, 4 << 20))

    @cached_property
    def silver_opportunity(self) -> DataFrame:
        return silver.opportunity(self.bronze.opportunity())

    @cached_property
    def silver_inventory(self) -> DataFrame:
        return silver.inventory(self.inventory_current)

    @cached_property
    def silver_product_catalog(self) -> DataFrame:
        return silver.product_catalog(self.product_history)

    @cached_property
    def silver_account(self) -> DataFrame:
        return silver.account(self.account_history)

    def silver(self, dataset: str) -> DataFrame:
        return getattr(self, f"silver_{dataset}")

    def valid(self, dataset: str) -> DataFrame:
        return quality.valid_rows(self.silver(dataset), quality.load_rules(dataset))

    def quarantine(self, dataset: str) -> DataFrame:
        return quality.quarantined_rows(self.silver(dataset), quality.load_rules(dataset))

    # -------------------------------------------------------------- gold
    @cached_property
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.valid("account"))

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.valid("product_catalog"))

    @cached_property
    def dim_date(self) -> DataFrame:
        if self.start and self.end:
            return gold.dim_date(gold.date_spine(self.spark, self.start, self.end))
        return gold.dim_date(gold.date_spine_covering(self.cleaned_transactions, "transaction_timestamp"))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return gold.fact_sales(self.valid("transactions"), self.valid("opportunity"))
