"""Bronze-shaped tables derived from the star-schema sample tables.

Every rule is a fixed function of the row's own keys, so that a second engine
can derive the same rows.  The rules plant what the quality rules look for:
blank and missing ids, unreadable values, unlisted categories, negative
amounts, repeated keys, changes and deletes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemart.sources.tables import pieces, spread


def _versions(key: str) -> str:
    """insert; an unchanged update; a real update; a delete."""
    return f"""inline(array_compact(array(
        named_struct('op', 'I', 'seq', timestamp'2024-01-01', 'version', 1),
        if({key} % 5 = 0, named_struct('op', 'U', 'seq', timestamp'2024-03-01', 'version', 1), null),
        if({key} % 3 = 0, named_struct('op', 'U', 'seq', timestamp'2024-06-01', 'version', 2), null),
        if({key} % 101 = 0, named_struct('op', 'D', 'seq', timestamp'2024-09-01', 'version', if({key} % 3 = 0, 2, 1)), null))))"""


def _address(kind: str) -> list[str]:
    return [
        f"concat(' Street ', c_custkey) as {kind}Street",
        f"if(c_custkey % 29 != 0, concat('City ', c_nationkey), null) as {kind}City",
        f"n_name as {kind}State",
        f"lpad(string(c_custkey), 8, '0') as {kind}PostalCode",
        f"r_name as {kind}Country",
    ]


class SampleBronze:
    """Lazily derived Bronze tables over one folder of sample tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return spread(df, by=df.columns[0])  # each table starts with its key

    def transactions(self, keep: tuple[str, ...] = ()) -> DataFrame:
        """Raw sales; ``keep`` adds columns of the sample table as they are."""
        price = "cast(l_extendedprice as decimal(10,2))"
        sold = (
            "timestampadd(SECOND, int(pmod(l_orderkey * 37 + l_linenumber, 86400)), cast(l_shipdate as timestamp))"
        )
        return self.table("lineitem").selectExpr(
            """case when l_orderkey % 113 = 0 then '  '
                    when l_orderkey % 127 != 0 then concat(' txn', l_orderkey, '-', l_linenumber, ' ')
               end as transaction_id""",
            "if(l_orderkey % 61 != 0, concat(' oPP ', l_orderkey, ' '), null) as opportunity_name",
            "concat(' p', l_partkey) as product_id",
            "concat('s', l_suppkey) as store_id",
            """case when l_orderkey % 97 = 0 then '0' when l_orderkey % 79 = 0 then 'n/a'
                    else string(int(l_quantity)) end as quantity""",
            f"{price} as selling_price",
            f"cast({price} * cast(l_discount as decimal(4,2)) as decimal(10,2)) as discount_amount",
            f"""if(l_orderkey % 89 = 0, 'not recorded', date_format({sold}, 'dd-MMM-yyyy hh.mm.ss a'))
                as transaction_timestamp""",
            """case when l_orderkey % 50 = 0 then 'Cheque' when l_suppkey % 4 = 0 then 'BLIK'
                    when l_suppkey % 4 = 1 then ' Card ' when l_suppkey % 4 = 2 then 'Cash'
                    else 'Bank Transfer ' end as payment_mode""",
            "if(l_linestatus = 'O', ' Online', 'Store ') as sales_channel",
            *keep,
        )

    def opportunity(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "concat('OPP-', o_orderkey) as Id",
            "o_orderkey % 53 = 0 as IsDeleted",
            "if(o_orderkey % 83 = 0, ' ', concat('ACC-', o_custkey)) as AccountId",
            "concat('Opp ', o_orderkey) as Name",
            "o_orderpriority as Description",
            """case when o_orderkey % 59 = 0 then 'Stalled'
                    when o_orderkey % 41 = 0 then null
                    when o_orderstatus = 'F' then 'Closed Won'
                    when o_orderstatus = 'O' then 'Negotiation/Review'
                    else 'Prospecting' end as StageName""",
            "cast(o_totalprice as decimal(18,2)) as Amount",
            """case when o_orderkey % 67 = 0 then 120.0D when o_orderstatus = 'F' then 100.0D
                    when o_orderstatus = 'O' then 60.0D else 10.0D end as Probability""",
            "cast(o_orderdate as date) as CloseDate",
            "'New Business' as Type",
            "cast(null as string) as NextStep",
            "'Web' as LeadSource",
            "o_orderstatus = 'F' as IsClosed",
            "o_orderstatus = 'F' as IsWon",
            "if(o_orderstatus = 'F', 'Closed', 'Pipeline') as ForecastCategory",
            "concat('USR-', o_custkey % 10) as OwnerId",
            "timestampadd(DAY, -30, cast(o_orderdate as timestamp)) as CreatedDate",
            "cast(o_orderdate as timestamp) as LastModifiedDate",
        )

    def account_feed(self) -> DataFrame:
        nations = self.table("nation").join(self.table("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
        rows = self.table("customer").join(nations.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
        return rows.selectExpr("*", _versions("c_custkey")).selectExpr(
            "op",
            "seq",
            "concat(' ACC-', c_custkey) as Id",
            "if(c_custkey % 211 != 0, false, null) as IsDeleted",
            "concat(' ', c_name, ' ') as Name",
            "c_mktsegment as Type",
            "if(c_custkey % 10 = 0, concat('ACC-', c_custkey div 10), null) as ParentId",
            *_address("Billing"),
            *_address("Shipping"),
            "if(c_custkey % 17 != 0, concat('+48 ', c_custkey, '-', version), null) as Phone",
            "concat('https://shop', c_custkey, '.example.com') as Website",
            "case when c_custkey % 13 = 1 then ' Retail ' when c_custkey % 13 > 1 then 'Wholesale' end as Industry",
            "cast(c_acctbal as decimal(18,2)) as AnnualRevenue",
            "if(c_custkey % 103 = 0, -5, int(c_custkey % 500) + (version - 1) * 10) as NumberOfEmployees",
            "concat('segment ', c_mktsegment) as Description",
        )

    def product_feed(self) -> DataFrame:
        suppliers = self.table("supplier").select("s_suppkey", "s_name")
        rows = self.spark.sql(
            "SELECT * FROM {part} JOIN {supplier} ON s_suppkey = p_partkey % (SELECT count(*) FROM {supplier})",
            part=self.table("part"),
            supplier=suppliers,
        )
        return rows.selectExpr("*", _versions("p_partkey")).selectExpr(
            "op",
            "seq",
            "concat(' p', p_partkey, ' ') as product_id",
            "if(p_partkey % 71 = 0, '', p_name) as product_name",
            """case p_type when 'STANDARD' then 'electronics' when 'ECONOMY' then 'mobile'
                    when 'MEDIUM' then 'appliances' when 'PROMO' then 'furniture'
                    when 'SMALL' then 'groceries' else 'oversize' end as category""",
            "if(p_partkey % 11 != 0, concat(' line ', lower(p_type)), null) as subcategory",
            "if(p_partkey % 7 != 0, p_brand, null) as brand",
            """cast(cast(p_retailprice as decimal(12,2)) * cast(p_size as decimal(4,0))
                    * cast(0.1 as decimal(2,1)) * cast(version as decimal(2,0)) as decimal(12,2)) as unit_price""",
            "s_name as supplier_name",
            "if(p_partkey % 31 != 0, date_add(date'2020-01-01', int(p_partkey % 1000)), null) as launch_date",
            "if(p_partkey % 37 != 0, seq, null) as updated_at",
        )

    def inventory_feed(self) -> DataFrame:
        pairs = self.table("lineitem").select("l_partkey", "l_suppkey")
        dealt = pieces(pairs)
        if dealt:
            pairs = pairs.repartition(dealt, "l_partkey", "l_suppkey")
        return pairs.distinct().selectExpr(
            "*",
            """inline(array_compact(array(
                named_struct('op', 'I', 'seq', timestamp'2024-01-01', 'extra', 0),
                if((l_partkey + l_suppkey) % 4 = 0, named_struct('op', 'U', 'seq', timestamp'2024-02-01', 'extra', 5), null),
                if((l_partkey + l_suppkey) % 97 = 0, named_struct('op', 'D', 'seq', timestamp'2024-03-01', 'extra', 5), null))))""",
        ).selectExpr(
            "op",
            "seq",
            "concat(' inv', l_partkey, '-', l_suppkey, ' ') as inventory_id",
            "concat('p', l_partkey) as product_id",
            "concat(' s', l_suppkey) as store_id",
            "int(l_partkey * l_suppkey % 50 - 1 + extra) as stock_quantity",
            "10 as reorder_level",
            "if(l_suppkey % 23 = 0, ' ', concat('WH-', l_suppkey % 5)) as warehouse_location",
            "if(l_partkey % 43 != 0, seq, null) as last_stock_update",
        )
