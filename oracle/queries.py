"""Oracle SQL per registered query."""

from __future__ import annotations

from oracle.layers import EXPECTATIONS, KEYS, RELATIONS, RULES, chunks, failed, product_texts, term_rows, with_sql


def plain(source: str, doubles: str = "", stamps: str = "", dates: str = "", where: str = "") -> str:
    """Whole relation with decimals as doubles and times as text."""
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles.split()]
    casts += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in stamps.split()]
    casts += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates.split()]
    replaced = f" REPLACE ({', '.join(casts)})" if casts else ""
    return f"SELECT *{replaced} FROM {source} {where}"


COLUMNS = {
    "transactions": ("selling_price gross_amount discount_amount net_amount", "transaction_timestamp", ""),
    "opportunity": ("amount", "created_date last_modified_date", "close_date"),
    "inventory": ("", "last_stock_update", ""),
    "product_catalog": ("unit_price", "start_at end_at updated_at", "launch_date"),
    "account": ("annual_revenue", "start_at end_at", ""),
}


def rule_lines(dataset: str) -> str:
    key = KEYS[dataset]
    return " UNION ALL ".join(
        f"SELECT {key} AS row_key, '{name}' AS rule FROM s_{dataset} WHERE {failed(p)}" for name, p in RULES[dataset]
    )


def expectation_lines(dataset: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS expectation, CAST(count(*) FILTER (WHERE {p}) AS BIGINT) AS passed, "
        f"CAST(count(*) - count(*) FILTER (WHERE {p}) AS BIGINT) AS failed FROM s_{dataset}"
        for name, p in EXPECTATIONS[dataset]
    )


def reconciliation() -> str:
    return " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, (SELECT count(*) FROM s_{d}) AS total, (SELECT count(*) FROM v_{d}) AS valid, "
        f"(SELECT count(*) FROM q_{d}) AS quarantined"
        for d in RULES
    )


def gold_quality() -> str:
    keys = {"fact_sales": "transaction_id", "dim_customer": "customer_id", "dim_product": "product_id", "dim_date": "date_key"}
    parts = []
    for t, k in keys.items():
        parts.append(f"SELECT '{t}.{k}_not_null' AS check_name, count(*) AS violations FROM {t} WHERE {k} IS NULL")
        parts.append(f"SELECT '{t}.{k}_unique', count(*) - count(DISTINCT {k}) FROM {t}")
    for dim, k, check in (
        ("dim_customer", "customer_id", "customer_fk"),
        ("dim_product", "product_id", "product_fk"),
        ("dim_date", "date_key", "date_fk"),
    ):
        parts.append(
            f"SELECT 'fact_sales.{check}', count(*) FROM fact_sales f LEFT JOIN {dim} d ON f.{k} = d.{k} "
            f"WHERE f.{k} IS NOT NULL AND d.{k} IS NULL"
        )
    return " UNION ALL ".join(parts)


def lsh_topk(tables: int = 10, bits: int = 5, probes: int = 3, sketch: int = 512, farthest: int = 232) -> str:
    """Codes and sketches from the same planes, then the cosine of the pairs that are left."""

    def planes(name: str, count: int) -> str:
        place = f"'{name}:' || b || ':' || d"
        return f"SELECT b, d, ('0x' || substr(md5({place}), 1, 4))::BIGINT - 32768 AS w FROM range({count}) p(b), range(64) q(d)"

    def products(rows: str, name: str, count: int) -> str:
        return f"SELECT id, b, sum(x * w) AS p FROM (SELECT id, unnest(range(64)) AS d, floor(unnest(v) * 65536)::BIGINT AS x FROM {rows}) JOIN ({planes(name, count)}) USING (d) GROUP BY id, b"

    def signs(rows: str) -> str:
        return f"SELECT id, b // {bits} AS t, sum(CASE WHEN p >= 0 THEN 1 << (b % {bits}) ELSE 0 END)::INT AS code FROM ({products(rows, 'code', tables * bits)}) GROUP BY ALL"

    return f"""
        WITH held AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        asked AS (SELECT label AS id, list(m ORDER BY place) AS v FROM (
            SELECT label, place, avg(CAST(x AS DOUBLE)) AS m FROM (
                SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS place FROM embeddings) GROUP BY 1, 2) GROUP BY label),
        near AS (
            SELECT id, b // {bits} AS t, 1 << (b % {bits}) AS flip FROM ({products("asked", "code", tables * bits)})
            QUALIFY row_number() OVER (PARTITION BY id, t ORDER BY abs(p), b) <= {probes}),
        own AS ({signs("asked")}),
        probed AS (SELECT * FROM own UNION ALL SELECT id, t, xor(code, flip::INT) FROM own JOIN near USING (id, t)),
        met AS (SELECT DISTINCT p.id AS label, h.id AS vec_id FROM probed p JOIN ({signs("held")}) h USING (t, code)),
        a AS (SELECT id, b, p >= 0 AS s FROM ({products("asked", "sketch", sketch)})),
        h AS (SELECT id, b, p >= 0 AS s FROM ({products("held", "sketch", sketch)})),
        left_over AS (
            SELECT label, vec_id FROM met JOIN a ON a.id = label JOIN h ON h.id = vec_id AND h.b = a.b
            GROUP BY ALL HAVING count(*) FILTER (a.s <> h.s) <= {farthest})
        SELECT label, vec_id, score, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM (
            SELECT label, vec_id, round(list_cosine_similarity(asked.v, held.v), 6) AS score
            FROM left_over JOIN asked ON asked.id = label JOIN held ON held.id = vec_id)
        QUALIFY rank <= 10"""


NET = "CAST(sum(f.net_sales_amount) AS DOUBLE) AS total_net_sales"
BY_CUSTOMER = "fact_sales f JOIN dim_customer c ON f.customer_id = c.customer_id"
BY_PRODUCT = "fact_sales f JOIN dim_product p ON f.product_id = p.product_id"
BY_DATE = "fact_sales f JOIN dim_date d ON f.date_key = d.date_key"
MONTHS = (
    f"SELECT d.month_year AS month, d.month_year_sort AS month_sort, sum(f.net_sales_amount) AS s FROM {BY_DATE} "
    "GROUP BY 1, 2"
)
ENTITIES = {
    "dim_date": ("day_name", "month_name", "month_year", "quarter_name"),
    "dim_product": ("brand", "category", "product_name", "product_segment", "subcategory", "supplier_name"),
    "fact_sales": ("payment_mode", "sales_channel"),
}
REGION = "NATION_3"
CUSTOMER_OUT = plain("dim_customer", doubles="annual_revenue")


def _sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    for d, (doubles, stamps, dates) in COLUMNS.items():
        sql[f"silver_{d}"] = plain("c_transactions" if d == "transactions" else f"s_{d}", doubles, stamps, dates)
        sql[f"valid_{d}"] = plain(f"v_{d}", doubles, stamps, dates)
        sql[f"quarantine_{d}"] = plain(f"q_{d}", doubles, stamps, dates)
        sql[f"expect_{d}"] = expectation_lines(d)
    sql["dedup_transactions"] = plain("s_transactions", *COLUMNS["transactions"])
    sql["quarantine_reasons"] = " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, row_key, rule FROM ({rule_lines(d)})" for d in RULES
    )
    sql["reconciliation"] = reconciliation()

    sql["scd2_account"] = sql["stream_scd2_account"] = plain("account_history", doubles="AnnualRevenue", stamps="__START_AT __END_AT")
    sql["scd2_product"] = plain("product_history", doubles="unit_price", stamps="updated_at __START_AT __END_AT", dates="launch_date")
    sql["scd1_inventory"] = sql["stream_scd1_inventory"] = plain("b_inventory", stamps="last_stock_update")
    before = "SELECT * FROM product_history WHERE __START_AT <= TIMESTAMP '2024-05-01' AND (__END_AT IS NULL OR __END_AT > TIMESTAMP '2024-05-01')"
    after = "SELECT * FROM product_history WHERE __END_AT IS NULL"
    content = "product_name category subcategory brand supplier_name".split()
    picked = ", ".join(f"CASE WHEN n.product_id IS NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in (*content, "unit_price", "launch_date"))
    sql["table_diff"] = plain(f"""(
        SELECT CASE WHEN o.product_id IS NULL THEN 'insert' WHEN n.product_id IS NULL THEN 'delete' ELSE 'update' END AS change_type,
               trim(coalesce(n.product_id, o.product_id)) AS product_id, {picked}
        FROM ({before}) o FULL JOIN ({after}) n ON o.product_id = n.product_id
        WHERE o.product_id IS NULL OR n.product_id IS NULL OR o.unit_price <> n.unit_price)""", doubles="unit_price", dates="launch_date")  # fmt: skip

    sql["dim_customer"] = CUSTOMER_OUT
    sql["dim_product"] = plain("dim_product", doubles="unit_price", stamps="updated_at", dates="launch_date")
    sql["dim_date"] = plain("dim_date", dates="full_date month_start")
    sql["fact_sales"] = plain("fact_sales", doubles="selling_price discount_amount net_sales_amount")
    sql["gold_quality"] = gold_quality()

    # A whole run also quarantines sales with unreadable values: a quantity that is none.
    readable = "(SELECT * FROM fact_sales WHERE quantity IS NOT NULL)"
    sql["pipeline_reconciliation"] = reconciliation().replace("FROM v_transactions", "FROM v_transactions WHERE quantity IS NOT NULL").replace(
        "(SELECT count(*) FROM q_transactions)", "(SELECT count(*) FROM s_transactions) - (SELECT count(*) FROM v_transactions WHERE quantity IS NOT NULL)"
    )
    sql["pipeline_gold_report"] = gold_quality().replace("FROM fact_sales", f"FROM {readable}")
    sql["published_customers"] = (
        f"SELECT *, 'member' AS reader FROM ({CUSTOMER_OUT}) UNION ALL "
        f"SELECT * REPLACE ('********' AS phone), 'plain' AS reader FROM ({CUSTOMER_OUT}) WHERE billing_state = '{REGION}'"
    )
    sql["published_sales"] = f"SELECT month, month_sort, CAST(s AS DOUBLE) AS total_net_sales FROM ({MONTHS.replace('FROM fact_sales', f'FROM {readable}')})"
    sql["customer_row_filter"] = f"{CUSTOMER_OUT} WHERE billing_state = '{REGION}'".replace(
        "CAST(annual_revenue AS DOUBLE) AS annual_revenue",
        "CAST(annual_revenue AS DOUBLE) AS annual_revenue, '********' AS phone",
    )
    sql["customer_phone_mask"] = (
        "SELECT principal, customer_id, CASE WHEN principal = 'reader' THEN '********' ELSE phone END AS phone "
        "FROM dim_customer, (SELECT unnest(['admin', 'reader']) AS principal) "
        f"WHERE principal = 'admin' OR billing_state = '{REGION}'"
    )
    sql["principal_visibility"] = f"""
        SELECT s_name AS principal, s_acctbal > 5000 AS privileged,
               CASE WHEN s_acctbal > 5000 THEN (SELECT count(*) FROM dim_customer)
                    ELSE (SELECT count(*) FROM dim_customer WHERE billing_state = '{REGION}') END AS visible_rows,
               CASE WHEN s_acctbal > 5000 THEN 0 ELSE (SELECT count(*) FROM dim_customer WHERE billing_state = '{REGION}') END AS masked_phones
        FROM supplier"""

    sql["monthly_sales"] = f"SELECT month, month_sort, CAST(s AS DOUBLE) AS total_net_sales FROM ({MONTHS})"
    sql["top_customers"] = (
        f"SELECT c.customer_id, c.customer_name, c.customer_type, {NET} FROM {BY_CUSTOMER} "
        "GROUP BY 1, 2, 3 ORDER BY sum(f.net_sales_amount) DESC, 1, 2, 3 LIMIT 10"
    )
    sql["sales_by_category"] = f"SELECT p.category, {NET} FROM {BY_PRODUCT} GROUP BY 1"
    sql["sales_over_time"] = (
        "SELECT month, month_sort, CAST(s AS DOUBLE) AS total_net_sales, CAST(s - lag(s) OVER w AS DOUBLE) AS change, "
        "round(CAST(s - lag(s) OVER w AS DOUBLE) / CAST(lag(s) OVER w AS DOUBLE), 6) AS change_ratio "
        f"FROM ({MONTHS}) WINDOW w AS (ORDER BY month_sort)"
    )

    def shared(keys: str, source: str, extra: str = "") -> str:
        inner = f"SELECT {keys}, sum(f.net_sales_amount) AS s{extra} FROM {source} GROUP BY ALL"
        return (
            "SELECT * EXCLUDE (s), CAST(s AS DOUBLE) AS total_net_sales, "
            f"round(CAST(s AS DOUBLE) / CAST(sum(s) OVER () AS DOUBLE), 6) AS share FROM ({inner})"
        )

    sql["category_share"] = shared("p.category", BY_PRODUCT)
    sql["product_rank"] = (
        "SELECT product_id, product_name, CAST(s AS DOUBLE) AS total_net_sales, rank() OVER (ORDER BY s DESC) AS sales_rank FROM "
        f"(SELECT p.product_id, p.product_name, sum(f.net_sales_amount) AS s FROM {BY_PRODUCT} GROUP BY 1, 2)"
    )
    sql["supplier_sales"] = (
        f"SELECT p.supplier_name, {NET}, CAST(sum(f.quantity) AS BIGINT) AS units_sold, "
        f"count(DISTINCT p.product_id) AS products_sold FROM {BY_PRODUCT} GROUP BY 1"
    )
    sql["segment_mix"] = shared(
        "c.customer_type, c.industry", BY_CUSTOMER, ", count(DISTINCT c.customer_id) AS customers"
    )
    sql["channel_share"] = shared("f.sales_channel", "fact_sales f")
    sql["star_query_region_channel"] = f"""
        SELECT c.billing_state, f.sales_channel, d.year, {NET}
        FROM {BY_CUSTOMER} JOIN dim_date d ON f.date_key = d.date_key
        JOIN dim_product p ON f.product_id = p.product_id
        WHERE p.product_segment IN ('PREMIUM', 'MID_RANGE') AND f.payment_mode = 'Card' GROUP BY 1, 2, 3"""
    sql["entity_values"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {c} AS value, count(*) AS rows FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}"
        for t, columns in ENTITIES.items()
        for c in columns
    )
    simple = "trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))".format
    sql["value_match"] = f"""SELECT * FROM (
        WITH asked AS (
            SELECT s_suppkey AS question_id, string_split({simple("'How much did ' || substr(s_name, 1, 2) || substr(s_name, 4) || ' sell of Elecctronics by bank transfr in Janury, and Mobile to CASH?'")}, ' ') AS w FROM supplier),
        said AS (SELECT DISTINCT question_id, array_to_string(w[a + 1 : a + n], ' ') AS phrase FROM asked, range(40) x(a), range(1, 4) y(n) WHERE a + n <= len(w)),
        known AS (SELECT DISTINCT table_name, column_name, value, {simple("value")} AS t FROM ({sql["entity_values"]})),
        near AS (
            SELECT phrase, t, levenshtein(phrase, t) AS distance FROM (SELECT DISTINCT phrase FROM said) JOIN (SELECT DISTINCT t FROM known WHERE t <> '')
            ON abs(length(phrase) - length(t)) <= 2)
        SELECT question_id, table_name, column_name, value, CAST(min(distance) AS INT) AS distance
        FROM said JOIN near USING (phrase) JOIN known USING (t)
        WHERE distance <= CASE WHEN length(t) >= 8 THEN 2 WHEN length(t) >= 4 THEN 1 ELSE 0 END GROUP BY ALL)"""
    sql["product_sales_summary"] = plain("sales_summary", doubles="total_net_sales")
    sql["product_documents"] = "SELECT * FROM d_product"
    sql["product_chunks"] = "SELECT * FROM k_product"
    sql["document_chunks"] = "SELECT * FROM k_text"
    sql["page_text"] = "SELECT document_id, document_type, source, content FROM d_page"
    sql["page_chunks"] = "SELECT * FROM k_page"
    sql["rag_chunks"] = "SELECT * FROM k_rag"

    def catalog(where: str) -> str:
        shown = RELATIONS["s_product_catalog"].replace("FROM product_history", f"FROM product_history WHERE {where}")
        return chunks(f"({product_texts(f'({shown})').replace('sales_summary', '(SELECT * FROM sales_summary WHERE FALSE)')})")

    may = catalog("__START_AT <= TIMESTAMP '2024-05-01' AND (__END_AT IS NULL OR __END_AT > TIMESTAMP '2024-05-01')")
    sql["index_sync"] = f"""
        SELECT n.chunk_id, CASE WHEN o.chunk_id IS NULL OR o.chunk_to_retrieve <> n.chunk_to_retrieve THEN 'second' ELSE 'first' END AS run,
               256 AS dimensions
        FROM ({catalog("__END_AT IS NULL")}) n LEFT JOIN ({may}) o ON o.chunk_id = n.chunk_id"""
    words = term_rows(f"({catalog('__END_AT IS NULL')})", "chunk_id", "chunk_to_retrieve")
    sql["keyword_sync"] = f"""
        SELECT 'documents' AS statistic, CAST(NULL AS VARCHAR) AS term, count(*) AS value FROM ({catalog("__END_AT IS NULL")})
        UNION ALL SELECT 'words', NULL, count(*) FROM ({words})
        UNION ALL SELECT 'document_frequency', term, count(DISTINCT id) FROM ({words}) GROUP BY term"""
    sql["vector_topk"] = """
        SELECT label, vec_id, score, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM (
            SELECT c.label, e.vec_id, round(list_cosine_similarity(c.v, CAST(e.embedding AS DOUBLE[])), 6) AS score
            FROM embeddings e, (SELECT label, list(m ORDER BY place) AS v FROM (
                SELECT label, place, avg(CAST(x AS DOUBLE)) AS m FROM (
                    SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS place FROM embeddings) GROUP BY 1, 2)
                GROUP BY label) c)
        QUALIFY rank <= 10"""
    sql["lsh_topk"] = lsh_topk()
    sql["keyword_index_topk"] = "SELECT * FROM k_text_bm25 WHERE rank <= 10"
    sql["bm25_topk"] = "SELECT * FROM k_text_bm25 WHERE rank <= 10"
    sql["hybrid_topk"] = "SELECT * FROM k_text_hybrid"
    block = (
        "'Source: ' || coalesce(nullif(source_uri, ''), 'Unknown source') || chr(10) || "
        "'Document type: ' || coalesce(nullif(document_type, ''), 'Unknown') || chr(10) || "
        "'Product ID: ' || coalesce(nullif(product_id, ''), 'N/A') || chr(10) || "
        "'Category: ' || coalesce(nullif(category, ''), 'N/A') || chr(10) || "
        "'Content:' || chr(10) || coalesce(chunk_to_retrieve, '')"
    )
    sql["retrieval_context"] = f"""
        SELECT item_id AS question_id, text AS question,
               CASE WHEN trim(text) = '' THEN 'No question was provided.'
                    ELSE coalesce(body, 'The available knowledge does not contain enough information.') END AS context
        FROM benchmark LEFT JOIN (
            SELECT question_id, string_agg({block}, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS body
            FROM k_rag_hybrid JOIN k_rag USING (chunk_id) GROUP BY question_id) ON question_id = item_id"""
    sql["keyword_context"] = f"""
        SELECT question_id, question, CASE WHEN regexp_matches(coalesce(question, ''), '\\S')
                    THEN coalesce(body, 'The available knowledge does not contain enough information.') ELSE 'No question was provided.' END AS context
        FROM (SELECT item_id AS question_id, text AS question FROM benchmark
              UNION ALL VALUES (-1, ' ' || chr(9) || ' '), (-2, NULL), (-3, 'qqzx xzqq?')) q
        LEFT JOIN (
            SELECT question_id AS asked, string_agg({block}, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS body
            FROM k_rag_bm25 JOIN k_rag USING (chunk_id) WHERE rank <= 3 GROUP BY question_id) ON question_id = asked"""
    sql["normalized_history"] = """
        SELECT conv_id, turn, coalesce(role = 'assistant' AND (conv_id + turn) % 4 IN (0, 1), FALSE) AS collapsed,
               CASE WHEN role = 'assistant' AND (conv_id + turn) % 4 = 2 THEN 'm' || conv_id END AS id,
               CASE WHEN role = 'assistant' AND (conv_id + turn) % 4 = 2 THEN 'message' END AS type,
               role,
               CASE WHEN role = 'assistant' AND (conv_id + turn) % 4 = 1 THEN text || chr(10) || 'end'
                    WHEN role = 'assistant' AND (conv_id + turn) % 4 = 2
                    THEN '[{"text":' || to_json(text) || ',"type":"output_text"}]' ELSE text END AS content
        FROM conversations"""
    sql["stream_ingest_dedup"] = sql["stream_restart"] = sql["dedup_transactions"]
    sql["stream_expectations"] = f"SELECT 'transactions' AS dataset, * FROM ({expectation_lines('transactions')})"
    for d in ("opportunity", "inventory"):
        sql[f"stream_silver_{d}"] = sql[f"silver_{d}"]
    sql["stream_dedup_expiring"] = """
        WITH RECURSIVE e AS (SELECT CASE WHEN event_id % 50 <> 0 THEN user_id END AS user_id, ts FROM events),
        w AS (
            SELECT user_id, min(ts) AS first_at FROM e WHERE user_id IS NOT NULL GROUP BY user_id
            UNION ALL
            SELECT w.user_id, min(e.ts) FROM w JOIN e ON e.user_id = w.user_id AND e.ts >= w.first_at + INTERVAL 6 HOUR
            GROUP BY w.user_id, w.first_at)
        SELECT user_id, strftime(first_at, '%Y-%m-%d %H:%M:%S') AS first_at,
               (SELECT count(*) - 1 FROM e WHERE e.user_id = w.user_id AND e.ts >= w.first_at AND e.ts < w.first_at + INTERVAL 6 HOUR) AS repeats FROM w
        UNION ALL SELECT NULL, strftime(ts, '%Y-%m-%d %H:%M:%S'), 0 FROM e WHERE user_id IS NULL"""
    sql["stream_schema_evolution"] = """
        SELECT trim(CASE WHEN l_orderkey % 113 = 0 THEN '  '
                    WHEN l_orderkey % 127 <> 0 THEN ' txn' || l_orderkey || '-' || l_linenumber || ' ' END) AS transaction_id,
               's' || l_suppkey AS store_id,
               CASE WHEN l_orderkey % 97 = 0 THEN 0 WHEN l_orderkey % 79 <> 0 THEN CAST(l_quantity AS INT) END AS quantity,
               CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS selling_price,
               CASE WHEN l_linenumber IN (4, 5) THEN 'tier ' || (l_suppkey % 3) END AS loyalty_tier,
               CASE WHEN l_orderkey % 97 <> 0 AND l_orderkey % 79 = 0 THEN '{"quantity":"n/a"}' END AS _rescued_data
        FROM lineitem"""
    return sql


def oracle_sql() -> dict[str, str]:
    return {name: with_sql(text) for name, text in _sql().items()}
