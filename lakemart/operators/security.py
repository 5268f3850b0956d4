"""Row filter and column mask as views over a table, decided per principal."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.sources.tables import quoted

# Fixed value: what a reader without the right sees instead of a phone number.
MASK = "********"
# Group that sees everything, and the region open to all.
PRIVILEGED_GROUP, OPEN_REGION = "admins", "Mazowieckie"


@dataclass(frozen=True)
class Policy:
    """Who sees everything, and what the others see.

    ``memberships`` is a table (principal, member_of); ``privileged`` names
    single principals that need no group.
    """

    memberships: DataFrame
    group: str = PRIVILEGED_GROUP
    privileged: tuple[str, ...] = ()
    region_column: str = "billing_state"
    open_region: str = OPEN_REGION
    masked_columns: tuple[str, ...] = ("phone",)

    def is_privileged(self, principal: str) -> bool:
        if principal in self.privileged:
            return True
        hit = (F.col("principal") == principal) & (F.col("member_of") == self.group)
        return not self.memberships.filter(hit).isEmpty()


    def sql_right(self, members_path: str) -> str:
        """The right of whoever runs a statement, over a written membership table."""
        named = "".join(f" OR session_user() = {quoted(p)}" for p in self.privileged)
        member = f"SELECT count(*) > 0 FROM parquet.`{members_path}` WHERE principal = session_user() AND member_of = {quoted(self.group)}"
        return f"(({member}){named})"

    def sql_filter(self, members_path: str) -> str:
        """Condition on the rows of a published table."""
        return f"{self.sql_right(members_path)} OR `{self.region_column}` = {quoted(self.open_region)}"

    def sql_masks(self, members_path: str) -> dict[str, str]:
        """What a published table shows in place of the masked columns."""
        right = self.sql_right(members_path)
        return {c: f"CASE WHEN {right} THEN `{c}` ELSE {quoted(MASK)} END" for c in self.masked_columns}


def current_principal(spark: SparkSession) -> str:
    return spark.range(1).select(F.session_user()).head()[0]


def register_functions(spark: SparkSession, policy: Policy, principal: str | None = None) -> None:
    """The two security functions for SQL text, settled for one principal.

    ``filter_customer_region(billing_state)`` and ``mask_customer_phone(phone)``
    last as long as the session.  Registering fails if the policy cannot be
    read, so doing it before Gold keeps an unprotected Gold from being built.
    """
    right = str(policy.is_privileged(principal or current_principal(spark))).lower()
    region = policy.open_region.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION filter_customer_region(billing_state STRING) "
        f"RETURNS BOOLEAN RETURN {right} OR billing_state = '{region}'"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_customer_phone(phone STRING) "
        f"RETURNS STRING RETURN CASE WHEN {right} THEN phone ELSE '{MASK}' END"
    )


def row_filter(privileged: Column, region: Column, open_region: str) -> Column:
    return privileged | (region == open_region)


def mask(privileged: Column, value: Column) -> Column:
    """The value, or the mask; an absent value is masked like any other."""
    return F.when(privileged, value).otherwise(F.lit(MASK))


def secure_view(df: DataFrame, policy: Policy, principal: str | None = None) -> DataFrame:
    """The rows and values one principal (default: the session user) may see.

    The right is settled before planning, so it is a constant: a privileged
    reader scans without a filter, for others the region test reaches the scan.
    """
    who = principal or current_principal(df.sparkSession)
    right = F.lit(policy.is_privileged(who))
    visible = df.filter(row_filter(right, F.col(policy.region_column), policy.open_region))
    return visible.withColumns({c: mask(right, F.col(c)) for c in policy.masked_columns})


def visibility(df: DataFrame, policy: Policy, principals: DataFrame) -> DataFrame:
    """Rows and readable phones each principal sees, for all principals at once.

    Counts per region (and over all regions) come first; every principal then
    looks up the one line that applies, so no row meets every principal.
    """
    region = F.col(policy.region_column)
    everything = F.grouping(region)
    counts = df.rollup(policy.region_column).agg(
        everything.alias("whole"),
        F.count(F.lit(1)).alias("visible_rows"),
        F.count(policy.masked_columns[0]).alias("given"),
    )
    scopes = counts.filter((F.col("whole") == 1) | (region == policy.open_region))

    admins = (
        policy.memberships.filter(F.col("member_of") == policy.group)
        .select("principal")
        .distinct()
        .withColumn("_admin", F.lit(True))
    )
    asked = principals.select("principal").distinct().join(admins, "principal", "left")
    right = F.col("_admin").isNotNull() | F.col("principal").isin(*policy.privileged)
    asked = asked.withColumn("privileged", right).withColumn("whole", right.cast("tinyint"))
    seen = asked.join(F.broadcast(scopes), "whole", "left")  # two rows at most
    rows = F.coalesce("visible_rows", F.lit(0))
    return seen.select(
        "principal",
        "privileged",
        rows.alias("visible_rows"),
        F.when(F.col("privileged"), F.lit(0)).otherwise(rows).alias("masked_phones"),
    )
