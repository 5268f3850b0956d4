"""Every query by name: (session, folder of sample tables) -> DataFrame."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampType

from lakemart.operators import cdc, chat, documents, gates, gold, keyword_index, keyword_stats, lsa, quality, retrieval, security, silver, value_match, vector_index
from lakemart.plans import marts, semantics
from lakemart.plans.medallion import SALES_ORDER, Medallion
from lakemart.plans.pipeline import Config, Result, publish_gold, run_pipeline
from lakemart.plans.samples import SampleBronze
from lakemart.session import scratch_dir
from lakemart.sources.tables import estimated_bytes, materialize
from lakemart.streaming import committed, expiring, ingest
from lakemart.streaming import silver as stream_silver

Query = Callable[[SparkSession, str], DataFrame]

SAMPLE_REGION = "NATION_3"
FILE_BYTES = 16 << 20  # of the table that a delivered file is made from
FILE_ROWS = 1_000_000  # at most in a delivered file: a compressed one is read by one task


def medallion(spark: SparkSession, folder: str) -> Medallion:
    return Medallion(SampleBronze(spark, folder))


def portable(df: DataFrame) -> DataFrame:
    """Types any engine compares alike: doubles for money, text for times."""

    def cast(f):
        if isinstance(f.dataType, DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, DateType):
            return F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, TimestampType):
            return F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        return F.col(f.name)

    hidden = {"processed_at", "_errors", "_warnings"}
    return df.select(*(cast(f) for f in df.schema if f.name not in hidden))


def _layers(build: Callable[[Medallion], DataFrame]) -> Query:
    return lambda spark, folder: portable(build(medallion(spark, folder)))


def _mart(build: Callable[[gates.Star], DataFrame]) -> Query:
    # A Medallion is a star whose tables are planned only when asked for.
    return _layers(build)


def _product_diff(m: Medallion) -> DataFrame:
    """What changed between the catalog of May 2024 and the latest one."""
    versions = materialize(m.product_history, "product-history")
    day = F.lit("2024-05-01").cast("timestamp")
    end = F.col("__END_AT")
    may = versions.filter((F.col("__START_AT") <= day) & (end.isNull() | (end > day)))
    latest = versions.filter(end.isNull())
    content = [c for c in versions.columns if c not in ("__START_AT", "__END_AT", "updated_at")]
    diff = cdc.table_diff(may.select(*content), latest.select(*content), "product_id")
    return diff.withColumn("product_id", F.trim("product_id"))


def _all_reasons(m: Medallion) -> DataFrame:
    keys = {
        "transactions": "transaction_id",
        "opportunity": "id",
        "inventory": "inventory_id",
        "product_catalog": "product_id",
        "account": "id",
    }
    parts = [
        quality.reasons(m.quarantine(d), key).select(F.lit(d).alias("dataset"), "row_key", "rule")
        for d, key in keys.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _reconciliation(m: Medallion) -> DataFrame:
    """Counted on written Silver tables, as a run does it."""
    parts = {}
    for d in quality.DATASETS:
        table = materialize(m.silver(d), f"silver-{d}")
        parts[d] = (table, *quality.split(table, quality.load_rules(d)))
    return gates.reconcile(parts)


# What the checks of the star schema look at.
CHECKED = {
    "fact_sales": ("transaction_id", "customer_id", "product_id", "date_key"),
    "dim_customer": ("customer_id",),
    "dim_product": ("product_id",),
    "dim_date": ("date_key",),
}


def _gold_quality(m: Medallion) -> DataFrame:
    return gates.gold_checks(gates.Star(**{t: materialize(getattr(m, t).select(*columns), t) for t, columns in CHECKED.items()}))


def _policy(m: Medallion) -> security.Policy:
    """Suppliers stand in for readers; the wealthy ones administrate."""
    members = m.bronze.table("supplier").filter("s_acctbal > 5000")
    members = members.select(
        F.col("s_name").alias("principal"), F.lit(security.PRIVILEGED_GROUP).alias("member_of")
    )
    return security.Policy(members, privileged=("admin",), open_region=SAMPLE_REGION)


def _visibility(m: Medallion) -> DataFrame:
    readers = m.bronze.table("supplier").select(F.col("s_name").alias("principal"))
    return security.visibility(m.dim_customer, _policy(m), readers)


def _phone_mask(m: Medallion) -> DataFrame:
    policy = _policy(m)
    views = [
        security.secure_view(m.dim_customer, policy, who).select(F.lit(who).alias("principal"), "customer_id", "phone")
        for who in ("admin", "reader")
    ]
    return views[0].unionByName(views[1])


# ------------------------------------------------------------------ whole runs

_runs: dict[tuple[str, str], Result] = {}


def _run(m: Medallion) -> Result:
    """One run of all stages over the sample tables, published; made once per session and folder."""
    key = m.spark.sparkContext.applicationId, m.bronze.folder
    if key not in _runs:
        root = scratch_dir(m.spark, "whole-run")
        schema = "run_" + hashlib.md5(root.encode()).hexdigest()[:12]
        m.spark.sql(f"CREATE DATABASE {schema} LOCATION '{root}/catalog'")
        # The sample sales refer to customers and products that quality has taken out.
        cfg = Config(root, "first", allowed_gold_violations=10**12, pages=f"{m.bronze.folder}/pages.parquet", schema=schema, policy=_policy(m))
        _runs[key] = run_pipeline(m.bronze, cfg)
    return _runs[key]


def _published_customers(m: Medallion) -> DataFrame:
    """The customer table read by name: by a plain reader, then by the same one as a member of the group."""
    done = _run(m)
    name = f"{done.cfg.schema}.dim_customer"
    plain = m.spark.table(name)
    me = m.spark.range(1).select(F.session_user().alias("principal"), F.lit(security.PRIVILEGED_GROUP).alias("member_of"))
    joined = replace(done.cfg, run="joined", policy=replace(done.cfg.policy, memberships=done.cfg.policy.memberships.unionByName(me)))
    publish_gold(m.spark, joined, done.paths)
    member = m.spark.table(name)
    publish_gold(m.spark, done.cfg, done.paths)
    return plain.withColumn("reader", F.lit("plain")).unionByName(member.withColumn("reader", F.lit("member")))


def _published_sales(m: Medallion) -> DataFrame:
    """Monthly sales as SQL over the published names."""
    schema = _run(m).cfg.schema
    return m.spark.sql(
        f"""SELECT month_year AS month, month_year_sort AS month_sort, sum(net_sales_amount) AS total_net_sales
            FROM {schema}.fact_sales JOIN {schema}.dim_date USING (date_key) GROUP BY ALL"""
    )


# ------------------------------------------------------------------ documents


def _sales_summary(m: Medallion) -> DataFrame:
    return documents.product_sales_summary(m.fact_sales)


def _product_documents(m: Medallion) -> DataFrame:
    return documents.product_documents(m.dim_product, _sales_summary(m))


def _page_documents(m: Medallion) -> DataFrame:
    return documents.page_documents(m.bronze.table("pages"))


def _document_chunks(m: Medallion) -> DataFrame:
    return documents.combine(documents.chunk(documents.text_documents(m.bronze.table("documents"))))


def _page_chunks(m: Medallion) -> DataFrame:
    return documents.explode_prepared(documents.prepare(_page_documents(m)))


def _rag_chunks(m: Medallion) -> DataFrame:
    return documents.combine(documents.chunk(_product_documents(m)), _page_chunks(m))


def _questions(m: Medallion) -> DataFrame:
    return m.bronze.table("benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )


def _label_centres(m: Medallion) -> DataFrame:
    """Mean vector of each label, as the vectors to search for."""
    places = m.bronze.table("embeddings").select("label", F.posexplode("embedding").alias("place", "x"))
    means = places.groupBy("label", "place").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "mean"))), lambda p: p.mean)
    return means.groupBy("label").agg(listed.alias("embedding"))


def _vector_topk(m: Medallion) -> DataFrame:
    return retrieval.vector_topk(
        _label_centres(m), m.bronze.table("embeddings").select("vec_id", "embedding"), 10, "label", "vec_id"
    )


def _lsh_topk(m: Medallion) -> DataFrame:
    index = vector_index.SignIndex()
    filed = index.write(m.bronze.table("embeddings"), scratch_dir(m.spark, "sign-index"), "vec_id")
    return index.topk(_label_centres(m), filed, 10, "label", "vec_id")


def _lsa_topk(m: Medallion) -> DataFrame:
    """Questions and chunks by an embedding learned from the chunks; as iterative as its fit, so without SQL."""
    chunks = materialize(_document_chunks(m), "document-chunks")
    embedder = lsa.LatentEmbedder().fit(chunks, "chunk_to_embed")
    return retrieval.vector_topk(embedder.embed(_questions(m), "question"), embedder.embed(chunks, "chunk_to_embed"), 10)


def _keyword_index_topk(m: Medallion) -> DataFrame:
    index = keyword_index.KeywordIndex(scratch_dir(m.spark, "keyword-index")).write(_document_chunks(m))
    return index.topk(_questions(m))


def _bm25_topk(m: Medallion) -> DataFrame:
    return retrieval.bm25_topk(_questions(m), _document_chunks(m))


def _hybrid(m: Medallion, chunks: DataFrame) -> DataFrame:
    embedder = retrieval.HashedEmbedder().fit(chunks, "chunk_to_embed")
    return retrieval.hybrid_topk(_questions(m), chunks, embedder)


def _hybrid_topk(m: Medallion) -> DataFrame:
    return _hybrid(m, materialize(_document_chunks(m), "document-chunks"))


def _retrieval_context(m: Medallion) -> DataFrame:
    chunks = materialize(_rag_chunks(m), "rag-chunks")
    hits = retrieval.retrieved_columns(_hybrid(m, chunks), chunks)
    return retrieval.contexts(_questions(m), hits)


def _keyword_context(m: Medallion) -> DataFrame:
    """Contexts by keyword search, for blank questions and one that nothing answers as well."""
    chunks = materialize(_rag_chunks(m), "rag-chunks")
    odd = m.spark.sql("SELECT stack(3, -1L, ' \t ', -2L, CAST(NULL AS STRING), -3L, 'qqzx xzqq?') AS (question_id, question)")
    questions = materialize(_questions(m).unionByName(odd), "questions")
    hits = retrieval.bm25_topk(questions, chunks, 3)
    return retrieval.contexts(questions, retrieval.retrieved_columns(hits, chunks))


def _catalog_chunks(m: Medallion, versions: DataFrame) -> DataFrame:
    """Chunks of the product documents of one state of the catalog."""
    never_sold = m.spark.createDataFrame(
        [], "product_id string, total_units_sold bigint, total_net_sales decimal(24,2), transaction_count bigint"
    )
    current = silver.product_catalog(versions.withColumn("__END_AT", F.lit(None).cast("timestamp")))
    return documents.combine(documents.chunk(documents.product_documents(gold.dim_product(current), never_sold)))


def _two_catalogs(m: Medallion) -> tuple[DataFrame, DataFrame]:
    """Written chunks of the catalog of May 2024 and of the latest one."""
    day, end = F.lit("2024-05-01").cast("timestamp"), F.col("__END_AT")
    versions = materialize(m.product_history, "product-history")
    may = versions.filter((F.col("__START_AT") <= day) & (end.isNull() | (end > day)))
    old = materialize(_catalog_chunks(m, may), "old-chunks")
    return old, materialize(_catalog_chunks(m, versions.filter(end.isNull())), "new-chunks")


def _index_sync(m: Medallion) -> DataFrame:
    """Which run embedded each chunk, and as what, after the catalog moved on from May 2024."""
    old, new = _two_catalogs(m)
    embedder = retrieval.HashedEmbedder().fit(old, "chunk_to_embed")

    def embed(chunks: DataFrame, run: str) -> DataFrame:
        return embedder.embed(chunks, "chunk_to_embed").select("chunk_id", "embedding", F.lit(run).alias("run"))

    synced = retrieval.sync_index(embed(old, "first"), old, new, lambda chunks: embed(chunks, "second"))
    return synced.select("chunk_id", "run", F.size("embedding").alias("dimensions"))


def _keyword_sync(m: Medallion) -> DataFrame:
    """Keyword statistics of May 2024 brought up to the latest catalog."""
    old, new = _two_catalogs(m)
    known = materialize(keyword_stats.statistics(old), "keyword-statistics")
    return keyword_stats.sync_statistics(known, old, new)


def _value_match(m: Medallion) -> DataFrame:
    """Questions with a letter lost or doubled, and the values they may mean."""
    named = m.bronze.table("supplier").select("s_suppkey", "s_name")
    lost = F.concat(F.substring("s_name", 1, 2), F.expr("substring(s_name, 4)"))
    asked = F.concat(F.lit("How much did "), lost, F.lit(" sell of Elecctronics by bank transfr in Janury, and Mobile to CASH?"))
    questions = named.select(F.col("s_suppkey").alias("question_id"), asked.alias("question"))
    values = semantics.entity_values(m).groupBy("table_name", "column_name", "value").agg(F.sum("rows").alias("rows"))
    return value_match.match_values(questions, values)


def _history_items(m: Medallion) -> DataFrame:
    """Conversation turns as replayed items, assistants in four spellings."""
    turns = m.bronze.table("conversations")
    return turns.selectExpr(
        "conv_id",
        "turn",
        """parse_json(case
             when role != 'assistant' then to_json(named_struct('role', role, 'content', text))
             when (conv_id + turn) % 4 = 0 then to_json(named_struct('type', 'message', 'role', role, 'content', text))
             when (conv_id + turn) % 4 = 1 then to_json(named_struct('type', 'message', 'role', role, 'content', array(
                    named_struct('type', 'output_text', 'text', text), named_struct('type', 'refusal', 'text', 'no'),
                    named_struct('type', 'output_text', 'text', 'end'))))
             when (conv_id + turn) % 4 = 2 then to_json(named_struct('id', concat('m', conv_id), 'type', 'message', 'role', role,
                    'content', array(named_struct('type', 'output_text', 'text', text))))
             else to_json(named_struct('role', role, 'content', text)) end) as item""",
    )


def _normalized_history(m: Medallion) -> DataFrame:
    done = chat.normalize_history(_history_items(m))
    return done.select(
        "conv_id",
        "turn",
        "collapsed",
        *(F.try_variant_get("item", f"$.{f}", "string").alias(f) for f in ("id", "type", "role")),
        F.try_variant_get("item", "$.content", "string").alias("content"),
    )


# -------------------------------------------------------------------- streams


def _drop(df: DataFrame, folder: str) -> None:
    """Write rows as compressed CSV files of a bounded size, the way the shops deliver them."""
    df.write.mode("append").option("maxRecordsPerFile", FILE_ROWS).csv(
        folder, header=True, nullValue="null", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip"
    )


def _sales_streams(m: Medallion, root: str) -> tuple[ingest.CsvDrops, stream_silver.SilverStream]:
    drops = ingest.CsvDrops(f"{root}/in", f"{root}/bronze", f"{root}/state")
    return drops, stream_silver.SilverStream("transactions", silver.transactions, f"{root}/silver", f"{root}/silver-state", "transaction_id")


def _bring_up(m: Medallion, drops: ingest.CsvDrops, spec: stream_silver.SilverStream) -> None:
    ingest.run(m.spark, drops)
    stream_silver.run_committed(m.spark, drops, spec, SALES_ORDER)


def _stream_ingest_dedup(m: Medallion) -> DataFrame:
    """CSV files to Bronze to deduplicated Silver, run twice over the stream."""
    drops, spec = _sales_streams(m, scratch_dir(m.spark, "stream-dedup"))
    _drop(m.bronze.transactions(), drops.source)
    for _ in range(2):  # the second run finds nothing new
        _bring_up(m, drops, spec)
    return stream_silver.first_arrivals(spec).read(m.spark)


def _stream_expectations(m: Medallion) -> DataFrame:
    """Passed and failed rows per expectation, measured batch by batch on the way to Silver."""
    drops, spec = _sales_streams(m, scratch_dir(m.spark, "stream-expectations"))
    rows = m.bronze.transactions()
    # Five files, or as many as keep each of a bounded size; in three batches either way.
    files = max(5, -(-estimated_bytes(m.bronze.table("lineitem")) // FILE_BYTES))
    drops = replace(drops, max_files=-(-2 * files // 5))
    _drop(rows.repartition(files, "transaction_id"), drops.source)
    _bring_up(m, drops, spec)
    return stream_silver.read_metrics(m.spark, spec)


def _stream_silver(dataset: str, bronze: Callable[[Medallion], DataFrame]) -> Query:
    """A dataset without keyed state from files to Silver, two deliveries."""

    def query(m: Medallion) -> DataFrame:
        root = scratch_dir(m.spark, f"stream-{dataset}")
        rows = materialize(bronze(m), f"bronze-{dataset}")
        spec = stream_silver.SilverStream(dataset, silver.BUILDERS[dataset], f"{root}/silver", f"{root}/state")
        half = F.pmod(F.xxhash64(rows.columns[0]), F.lit(2))
        for part in (0, 1):
            rows.where(half == part).write.mode("append").parquet(f"{root}/in")
            stream_silver.run(m.spark.readStream.schema(rows.schema).parquet(f"{root}/in"), spec)
        return stream_silver.read_table(m.spark, spec)

    return _layers(query)


def _stream_restart(m: Medallion) -> DataFrame:
    """As above, but Bronze and Silver died half-way first, and all files are delivered twice."""
    drops, spec = _sales_streams(m, scratch_dir(m.spark, "stream-restart"))
    _drop(m.bronze.transactions(), drops.source)
    # What two runs that died before their record leave: some of their files, no record.
    some = m.bronze.transactions().where("store_id LIKE 's1%'")
    some.write.parquet(f"{drops.table}/{ingest.BATCH}=0")
    target = stream_silver.first_arrivals(spec, SALES_ORDER).store
    target.write(silver.transactions(some), "rows", 0)
    for _ in range(2):
        _bring_up(m, drops, spec)
    _drop(m.bronze.transactions(), drops.source)  # all of them again, under new names
    _bring_up(m, drops, spec)
    return stream_silver.first_arrivals(spec).read(m.spark)


def _delivered(m: Medallion, feed: DataFrame, target, root: str) -> None:
    """A change feed in three deliveries, the later changes mostly first, each run as a stream."""
    late = F.pmod(F.xxhash64(F.col(target.store.keys[0]), F.col("seq"), F.lit("delivery")), F.lit(2)) + (F.col("seq") < F.lit("2024-05-01").cast("timestamp")).cast("int")
    feed = materialize(feed.withColumn("_delivery", late), "change-feed")
    for delivery in range(3):
        rows = feed.where(F.col("_delivery") == delivery).drop("_delivery")
        rows.write.mode("append").parquet(f"{root}/feed")
        stream = m.spark.readStream.schema(rows.schema).parquet(f"{root}/feed")
        committed.run_changes(stream, target, f"{root}/checkpoint")


def _stream_dedup_expiring(m: Medallion) -> DataFrame:
    """First events of users within six hours, with their repeats, from three deliveries."""
    root = scratch_dir(m.spark, "stream-expiring")
    events = m.bronze.table("events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    # Every 50th event has lost its user.
    events = events.withColumn("user_id", F.when(F.col("event_id") % 50 != 0, F.col("user_id")))
    third = 1 + (F.col("ts") >= "2024-01-11").cast("int") + (F.col("ts") >= "2024-01-21").cast("int")
    events = materialize(events.withColumn("delivery", third), "events")
    end = m.spark.sql("SELECT -1L AS event_id, -1L AS user_id, timestamp'2100-01-01' AS ts")  # closes all windows
    dedup = expiring.ExpiringDedup("user_id", "ts", 6 * 3600)
    table = committed.CommittedParts(f"{root}/table", ("user_id",), parts=8)
    for rows in (*(events.where(F.col("delivery") == i).drop("delivery") for i in (1, 2, 3)), end):
        rows.write.mode("append").parquet(f"{root}/events")
        dedup.run(m.spark.readStream.schema(end.schema).parquet(f"{root}/events"), table, f"{root}/checkpoint")
    return dedup.read(m.spark, table)


def _stream_scd2_account(m: Medallion) -> DataFrame:
    root = scratch_dir(m.spark, "stream-scd2")
    target = committed.History(committed.CommittedParts(f"{root}/table", ("Id",), parts=8))
    _delivered(m, m.bronze.account_feed(), target, root)
    return target.read(m.spark)


def _stream_scd1_inventory(m: Medallion) -> DataFrame:
    root = scratch_dir(m.spark, "stream-scd1")
    target = committed.CurrentState(committed.CommittedParts(f"{root}/table", ("inventory_id",), parts=8))
    _delivered(m, m.bronze.inventory_feed(), target, root)
    return target.read(m.spark)


def _stream_schema_evolution(m: Medallion) -> DataFrame:
    """Three deliveries: as agreed, with a new column, in another order."""
    root = scratch_dir(m.spark, "stream-evolution")
    drops = ingest.CsvDrops(f"{root}/in", f"{root}/bronze", f"{root}/state")
    sales = m.bronze.transactions(keep=("l_linenumber", "l_suppkey"))
    line = F.col("l_linenumber")
    tier = F.concat(F.lit("tier "), F.col("l_suppkey") % 3)
    base = [c for c in sales.columns if c not in ("l_linenumber", "l_suppkey")]
    deliveries = (
        sales.filter(line <= 3).select(*base),
        sales.filter(line.between(4, 5)).select(*base, tier.alias("loyalty_tier")),
        sales.filter(line > 5).select(*reversed(base)),
    )
    for rows in deliveries:
        _drop(rows, drops.source)
        ingest.run(m.spark, drops)
    table = ingest.read_table(m.spark, drops)
    return table.select(
        F.trim("transaction_id").alias("transaction_id"),
        F.trim("store_id").alias("store_id"),
        "quantity",
        "selling_price",
        "loyalty_tier",
        ingest.RESCUED,
    )


def build_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for d in quality.DATASETS:
        if d == "transactions":
            q["silver_transactions"] = _layers(lambda m: m.cleaned_transactions)
            q["dedup_transactions"] = _layers(lambda m: m.silver("transactions"))
        else:
            q[f"silver_{d}"] = _layers(lambda m, d=d: m.silver(d))
        q[f"expect_{d}"] = _layers(lambda m, d=d: quality.measure(m.silver(d), quality.load_expectations(d)))
        q[f"valid_{d}"] = _layers(lambda m, d=d: m.valid(d))
        q[f"quarantine_{d}"] = _layers(lambda m, d=d: m.quarantine(d))
    q["quarantine_reasons"] = _layers(_all_reasons)
    q["reconciliation"] = _layers(_reconciliation)

    q["scd2_account"] = _layers(lambda m: m.account_history)
    q["scd2_product"] = _layers(lambda m: m.product_history)
    q["scd1_inventory"] = _layers(lambda m: m.inventory_current)
    q["table_diff"] = _layers(_product_diff)

    q["dim_customer"] = _layers(lambda m: m.dim_customer)
    q["dim_product"] = _layers(lambda m: m.dim_product)
    q["dim_date"] = _layers(
        lambda m: gold.dim_date(gold.date_spine_covering(m.bronze.table("lineitem"), "l_shipdate"))
    )
    q["fact_sales"] = _layers(lambda m: m.fact_sales)
    q["gold_quality"] = _layers(_gold_quality)

    q["pipeline_reconciliation"] = _layers(lambda m: _run(m).reconciliation)
    q["pipeline_gold_report"] = _layers(lambda m: _run(m).gold_report)
    q["published_customers"] = _layers(_published_customers)
    q["published_sales"] = _layers(_published_sales)
    q["customer_row_filter"] = _layers(lambda m: security.secure_view(m.dim_customer, _policy(m), "reader"))
    q["customer_phone_mask"] = _layers(_phone_mask)
    q["principal_visibility"] = _layers(_visibility)

    q["monthly_sales"] = _mart(marts.monthly_sales)
    q["top_customers"] = _mart(marts.top_customers)
    q["sales_by_category"] = _mart(marts.sales_by_category)
    q["sales_over_time"] = _mart(marts.sales_over_time)
    q["category_share"] = _mart(marts.category_share)
    q["product_rank"] = _mart(marts.product_rank)
    q["supplier_sales"] = _mart(marts.supplier_sales)
    q["segment_mix"] = _mart(marts.segment_mix)
    q["channel_share"] = _mart(marts.channel_share)
    q["star_query_region_channel"] = _mart(
        lambda star: semantics.star_query(
            star,
            ["billing_state", "sales_channel", "year"],
            "revenue",
            filters={"product_segment": ["PREMIUM", "MID_RANGE"], "payment_mode": "Card"},
        )
    )
    q["value_match"] = _layers(_value_match)
    q["entity_values"] = _mart(semantics.entity_values)

    q["product_sales_summary"] = _layers(_sales_summary)
    q["product_documents"] = _layers(_product_documents)
    q["product_chunks"] = _layers(lambda m: documents.combine(documents.chunk(_product_documents(m))))
    q["document_chunks"] = _layers(_document_chunks)
    q["page_text"] = _layers(_page_documents)
    q["page_chunks"] = _layers(lambda m: documents.combine(_page_chunks(m)))
    q["rag_chunks"] = _layers(_rag_chunks)
    q["index_sync"] = _layers(_index_sync)
    q["keyword_sync"] = _layers(_keyword_sync)
    q["vector_topk"] = _layers(_vector_topk)
    q["lsh_topk"] = _layers(_lsh_topk)
    q["lsa_topk"] = _layers(_lsa_topk)
    q["keyword_index_topk"] = _layers(_keyword_index_topk)
    q["bm25_topk"] = _layers(_bm25_topk)
    q["hybrid_topk"] = _layers(_hybrid_topk)
    q["retrieval_context"] = _layers(_retrieval_context)
    q["keyword_context"] = _layers(_keyword_context)
    q["normalized_history"] = _layers(_normalized_history)

    q["stream_ingest_dedup"] = _layers(_stream_ingest_dedup)
    q["stream_expectations"] = _layers(_stream_expectations)
    q["stream_silver_opportunity"] = _stream_silver("opportunity", lambda m: m.bronze.opportunity())
    q["stream_silver_inventory"] = _stream_silver("inventory", lambda m: m.inventory_current)
    q["stream_restart"] = _layers(_stream_restart)
    q["stream_dedup_expiring"] = _layers(_stream_dedup_expiring)
    q["stream_scd2_account"] = _layers(_stream_scd2_account)
    q["stream_scd1_inventory"] = _layers(_stream_scd1_inventory)
    q["stream_schema_evolution"] = _layers(_stream_schema_evolution)
    return q
