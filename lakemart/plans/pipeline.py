"""The whole run: ingest, Silver, quality, gate, Gold, gate, search chunks.

Every stage reads what the stage before it wrote, so a stage is planned over
plain tables and a lost executor costs a stage's tasks at most.  A run writes
below its own folder; the catalog names move to it at the end.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.columns import match_key
from lakemart.operators import documents, gates, gold, quality, retrieval, security
from lakemart.operators.skew import heavy_keys
from lakemart.plans.medallion import Medallion
from lakemart.sources.tables import TableSpec, publish, write_table
from lakemart.streaming import ingest

# What the catalog says about the Gold tables.
GOLD_PROPERTIES = {"quality": "gold", "layer": "gold"}
COMMENTS = {
    "fact_sales": "Sales fact, one row per transaction",
    "dim_customer": "Customer dimension; readers go through the secure view",
    "dim_product": "Product dimension, active products",
    "dim_date": "Date dimension",
}


@dataclass(frozen=True)
class Config:
    root: str
    run: str
    start: date | None = None  # of the calendar, by default all years of the sales
    end: date | None = None
    drops: ingest.CsvDrops | None = None  # CSV deliveries to ingest first
    pages: str | None = None  # Parquet table (url, html)
    allowed_gold_violations: int = 0
    previous_run: str | None = None  # to synchronise the search index from
    schema: str | None = None  # catalog schema to publish Gold in; needs a policy
    null_passes: bool = True
    policy: security.Policy | None = None  # who may see which customers

    def path(self, layer: str, table: str, run: str | None = None) -> str:
        return f"{self.root}/{run or self.run}/{layer}/{table}"


@dataclass
class Result:
    reconciliation: DataFrame
    gold_report: DataFrame
    star: gates.Star
    chunks: DataFrame
    index: DataFrame
    policy: security.Policy | None = None
    paths: dict[str, str] = field(default_factory=dict)
    cfg: Config | None = None

    def star_for(self, principal: str) -> gates.Star:
        """The star schema as one principal may see it, for reports."""
        if self.policy is None:
            return self.star
        return replace(self.star, dim_customer=security.secure_view(self.star.dim_customer, self.policy, principal))


def build_silver(source: Medallion, cfg: Config) -> dict[str, DataFrame]:
    return {d: write_table(source.silver(d), cfg.path("silver", d)) for d in quality.DATASETS}


def split_quality(tables: dict[str, DataFrame], cfg: Config) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Judge each table and write its two sides, each in a pass of its own: one pass would sort all rows by side."""
    sides = {}
    for dataset, table in tables.items():
        judged = quality.annotate(table, quality.load_rules(dataset), cfg.null_passes)
        verdict = F.when(F.size("_errors") == 0, F.lit("valid")).otherwise(F.lit("quarantine"))
        path = cfg.path("judged", dataset)
        # The schema is known, so an empty side reads as an empty table.
        schema = judged.schema
        for side in ("valid", "quarantine"):
            write_table(judged.where(verdict == side), f"{path}/verdict={side}")
        both = table.sparkSession.read.schema(schema.add("verdict", "string")).parquet(path)
        valid = both.filter("verdict = 'valid'").drop("verdict", "_errors", "_warnings", "parse_failures")
        sides[dataset] = (valid, both.filter("verdict = 'quarantine'").drop("verdict"))
    return sides


def build_gold(valid: dict[str, DataFrame], spark: SparkSession, cfg: Config) -> gates.Star:
    sales = valid["transactions"]
    # Deals that hold a large share of all sales are spread over the cluster.
    heavy = heavy_keys(sales, match_key("opportunity_name"))
    spine = gold.date_spine(spark, cfg.start, cfg.end) if cfg.start and cfg.end else gold.date_spine_covering(sales, "transaction_timestamp")
    tables = {
        "dim_customer": gold.dim_customer(valid["account"]),
        "dim_product": gold.dim_product(valid["product_catalog"]),
        "dim_date": gold.dim_date(spine),
        "fact_sales": gold.fact_sales(sales, valid["opportunity"], heavy),
    }
    return gates.Star(**{name: write_table(df, cfg.path("gold", name)) for name, df in tables.items()})


def build_chunks(star: gates.Star, spark: SparkSession, cfg: Config) -> DataFrame:
    summary = documents.product_sales_summary(star.fact_sales)
    parts = [documents.chunk(documents.product_documents(star.dim_product, summary))]
    if cfg.pages:
        parts.append(documents.chunk(documents.page_documents(spark.read.parquet(cfg.pages))))
    return write_table(documents.combine(*parts), cfg.path("ai", "rag_chunks"))


def build_index(chunks: DataFrame, spark: SparkSession, cfg: Config) -> DataFrame:
    """Embeddings of the chunks; only changed ones are computed again."""
    path = cfg.path("ai", "index")
    if cfg.previous_run:
        old = spark.read.parquet(cfg.path("ai", "rag_chunks", cfg.previous_run))
        index = spark.read.parquet(cfg.path("ai", "index", cfg.previous_run))
        # The model of an index does not change with its content.
        embedder = retrieval.HashedEmbedder.load(spark, cfg.path("ai", "embedder", cfg.previous_run))
        embed = lambda rows: embedder.embed(rows, "chunk_to_embed").select("chunk_id", "embedding")
        out = retrieval.sync_index(index, old, chunks, embed)
    else:
        embedder = retrieval.HashedEmbedder().fit(chunks, "chunk_to_embed")
        out = embedder.embed(chunks, "chunk_to_embed").select("chunk_id", "embedding")
    embedder.save(spark, cfg.path("ai", "embedder"))
    return write_table(out, path)


def publish_gold(spark: SparkSession, cfg: Config, paths: dict[str, str]) -> None:
    """Move the names of the Gold tables to this run, customers filtered and masked for whoever reads them."""
    # A folder of its own each time: readers of the former names still read the former one.
    members = cfg.path("governance", f"members-{uuid.uuid4().hex[:12]}")
    write_table(cfg.policy.memberships, members)
    for name, path in paths.items():
        spec = TableSpec(f"{cfg.schema}.{name}", COMMENTS[name], GOLD_PROPERTIES)
        if name == "dim_customer":
            publish(spark, spec, path, cfg.policy.sql_masks(members), cfg.policy.sql_filter(members))
        else:
            publish(spark, spec, path)


class _FromDrops:
    """A Bronze provider whose sales come from the ingested CSV deliveries."""

    def __init__(self, bronze, drops: ingest.CsvDrops):
        self._bronze, self._drops = bronze, drops
        self.spark = bronze.spark

    def __getattr__(self, name: str):
        return getattr(self._bronze, name)

    def transactions(self) -> DataFrame:
        return ingest.read_table(self.spark, self._drops)


def run_pipeline(bronze, cfg: Config) -> Result:
    """Run all stages in order; a failed gate raises and stops the run."""
    spark = bronze.spark
    if cfg.schema and not cfg.policy:
        raise ValueError("Gold is published under a policy only: customers have rows and numbers that not everybody may see")
    if cfg.drops:
        ingest.run(spark, cfg.drops)
        bronze = _FromDrops(bronze, cfg.drops)

    # Unreadable values are named, so that the rules can quarantine them.
    source = Medallion(bronze, cfg.start, cfg.end, flag_failures=True)

    tables = build_silver(source, cfg)
    sides = split_quality(tables, cfg)
    reconciliation = gates.reconcile({d: (tables[d], *sides[d]) for d in tables})
    gates.require_reconciled(reconciliation)

    if cfg.policy:
        # Settled before Gold exists: a policy that cannot be read stops here.
        security.register_functions(spark, cfg.policy)

    star = build_gold({d: valid for d, (valid, _) in sides.items()}, spark, cfg)
    report = gates.gold_checks(star)
    gates.require_gold(report, cfg.allowed_gold_violations)

    chunks = build_chunks(star, spark, cfg)
    index = build_index(chunks, spark, cfg)

    paths = {name: cfg.path("gold", name) for name in COMMENTS}
    if cfg.schema:
        publish_gold(spark, cfg, paths)
    return Result(reconciliation, report, star, chunks, index, cfg.policy, paths, cfg)
