"""Named SQL relations; ``with_sql`` strings together those a query needs."""

from __future__ import annotations

import re

# The contract's lists, rule names and predicates (STAGES, CATEGORIES, RULES, EXPECTATIONS).
STAGES = "('Prospecting', 'Qualification', 'Needs Analysis', 'Proposal/Price Quote', 'Negotiation/Review', 'Closed Won', 'Closed Lost')"
CATEGORIES = "('Electronics', 'Mobile', 'Appliances', 'Furniture', 'Groceries', 'Fashion', 'Accessories', 'Lifestyle', 'Home')"


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def filled(x: str) -> str:
    return f"({x} IS NOT NULL AND trim({x}) <> '')"


RULES = {
    "transactions": [
        ("non_null_transaction_id", filled("transaction_id")),
        ("valid_quantity", "quantity > 0"),
        ("valid_selling_price", "selling_price >= 0"),
        ("valid_discount_amount", "discount_amount >= 0"),
        ("non_null_product_id", filled("product_id")),
        ("non_null_store_id", filled("store_id")),
        ("valid_payment_mode", "payment_mode IS NOT NULL AND payment_mode IN ('BLIK', 'Card', 'Cash', 'Bank Transfer')"),
        ("valid_sales_channel", "sales_channel IS NOT NULL AND sales_channel IN ('Online', 'Store')"),
        ("valid_transaction_timestamp", "transaction_timestamp IS NOT NULL"),
    ],
    "opportunity": [
        ("non_null_opportunity_id", filled("id")),
        ("non_null_account_id", filled("account_id")),
        ("non_null_opportunity_name", filled("name")),
        ("valid_stage_name", f"stage_name IS NOT NULL AND stage_name IN {STAGES}"),
        ("valid_amount", "amount IS NOT NULL AND amount >= 0"),
        ("valid_probability", "probability IS NULL OR (probability >= 0 AND probability <= 100)"),
        ("non_null_close_date", "close_date IS NOT NULL"),
    ],
    "inventory": [
        ("non_null_inventory_id", filled("inventory_id")),
        ("non_null_product_id", filled("product_id")),
        ("non_null_store_id", filled("store_id")),
        ("valid_stock_quantity", "stock_quantity IS NOT NULL AND stock_quantity >= 0"),
        ("valid_reorder_level", "reorder_level IS NOT NULL AND reorder_level >= 0"),
        ("non_null_warehouse_location", filled("warehouse_location")),
        ("non_null_last_stock_update", "last_stock_update IS NOT NULL"),
    ],
    "product_catalog": [
        ("non_null_product_id", filled("product_id")),
        ("non_null_product_name", filled("product_name")),
        ("valid_category", f"category IS NOT NULL AND category IN {CATEGORIES}"),
        ("valid_unit_price", "unit_price IS NOT NULL AND unit_price >= 0"),
        ("non_null_supplier_name", filled("supplier_name")),
        ("non_null_start_at", "start_at IS NOT NULL"),
        ("non_null_updated_at", "updated_at IS NOT NULL"),
    ],
    "account": [
        ("non_null_account_id", filled("id")),
        ("non_null_customer_name", filled("customer_name")),
        ("valid_annual_revenue", "annual_revenue IS NULL OR annual_revenue >= 0"),
        ("valid_number_of_employees", "number_of_employees IS NULL OR number_of_employees >= 0"),
        ("non_null_start_at", "start_at IS NOT NULL"),
    ],
}

EXPECTATIONS = {
    "transactions": [
        *RULES["transactions"][:6],
        ("valid_payment_mode", "payment_mode IN ('BLIK', 'Card', 'Cash', 'Bank Transfer')"),
        ("valid_sales_channel", "sales_channel IN ('Online', 'Store')"),
        RULES["transactions"][8],
    ],
    "inventory": [
        ("non_null_inventory_id", filled("inventory_id")),
        ("valid_stock_quantity", "stock_quantity >= 0"),
        ("valid_reorder_level", "reorder_level >= 0"),
        ("non_null_product_id", filled("product_id")),
        ("non_null_store_id", filled("store_id")),
        ("valid_warehouse_location", filled("warehouse_location")),
        ("valid_stock_update", "last_stock_update IS NOT NULL"),
    ],
    "product_catalog": [
        ("valid_product_id", filled("product_id")),
        ("valid_product_name", filled("product_name")),
        ("valid_category", "category IS NOT NULL"),
        ("valid_price", "unit_price > 0"),
        ("valid_launch_date", "launch_date IS NOT NULL"),
        ("valid_supplier", "supplier_name IS NOT NULL"),
    ],
    "opportunity": [
        ("non_null_id", "id IS NOT NULL"),
        ("non_null_name", "name IS NOT NULL"),
        ("valid_amount", "amount IS NULL OR amount >= 0"),
        ("valid_probability", "probability IS NULL OR (probability >= 0 AND probability <= 100)"),
        ("valid_stage", f"stage_name IN {STAGES}"),
    ],
    "account": [
        ("non_null_id", filled("id")),
        ("non_null_customer_name", filled("customer_name")),
        ("valid_billing_country", filled("billing_country")),
        ("valid_billing_city", filled("billing_city")),
    ],
}

KEYS = {
    "transactions": "transaction_id",
    "opportunity": "id",
    "inventory": "inventory_id",
    "product_catalog": "product_id",
    "account": "id",
}


def failed(predicate: str) -> str:
    """Only a FALSE predicate fails a row."""
    return f"NOT coalesce(({predicate}), TRUE)"


def ok(dataset: str) -> str:
    return " AND ".join(f"coalesce(({p}), TRUE)" for _, p in RULES[dataset])


def changes(table: str, key: str, middle: str) -> str:
    """Versions of every row of ``table``: insert, no-op, update, delete."""
    return f"""
        SELECT 'I' AS op, TIMESTAMP '2024-01-01' AS seq, 1 AS version, t.* FROM {table} t
        UNION ALL
        SELECT 'U', TIMESTAMP '2024-03-01', 1, t.* FROM {table} t WHERE {middle}
        UNION ALL
        SELECT 'U', TIMESTAMP '2024-06-01', 2, t.* FROM {table} t WHERE {key} % 3 = 0
        UNION ALL
        SELECT 'D', TIMESTAMP '2024-09-01', CASE WHEN {key} % 3 = 0 THEN 2 ELSE 1 END, t.*
        FROM {table} t WHERE {key} % 101 = 0"""


def history(feed: str, key: str, track: str) -> str:
    return f"""
        SELECT * EXCLUDE (op, seq, state, was, __next), seq AS __START_AT, __next AS __END_AT FROM (
            SELECT *, lead(seq) OVER (PARTITION BY {key} ORDER BY seq) AS __next FROM (
                SELECT *, lag(state) OVER (PARTITION BY {key} ORDER BY seq) AS was FROM (
                    SELECT *, CASE WHEN op = 'D' THEN 'D'
                        ELSE CAST(struct_pack({track}) AS VARCHAR) END AS state
                    FROM {feed}))
            WHERE state IS DISTINCT FROM was)
        WHERE op <> 'D'"""


ADDRESS = ("Street", "City", "State", "PostalCode", "Country")
SNAKE = {"Street": "street", "City": "city", "State": "state", "PostalCode": "postal_code", "Country": "country"}
SALES_ORDER = ", ".join(
    f"{c} ASC NULLS FIRST"
    for c in (
        "transaction_timestamp", "opportunity_name", "product_id", "store_id",
        "quantity", "selling_price", "discount_amount", "payment_mode", "sales_channel",
    )
)

RELATIONS = {
    # ------------------------------------------------------------ bronze
    "b_transactions": """
        SELECT CASE WHEN l_orderkey % 113 = 0 THEN '  '
                    WHEN l_orderkey % 127 <> 0 THEN ' txn' || l_orderkey || '-' || l_linenumber || ' ' END AS transaction_id,
               CASE WHEN l_orderkey % 61 <> 0 THEN ' oPP ' || l_orderkey || ' ' END AS opportunity_name,
               ' p' || l_partkey AS product_id, 's' || l_suppkey AS store_id,
               CASE WHEN l_orderkey % 97 = 0 THEN '0' WHEN l_orderkey % 79 = 0 THEN 'n/a'
                    ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS quantity,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS selling_price,
               CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS discount_amount,
               CASE WHEN l_orderkey % 89 = 0 THEN 'not recorded'
                    ELSE strftime(l_shipdate + to_seconds((l_orderkey * 37 + l_linenumber) % 86400), '%d-%b-%Y %I.%M.%S %p') END AS transaction_timestamp,
               CASE WHEN l_orderkey % 50 = 0 THEN 'Cheque' WHEN l_suppkey % 4 = 0 THEN 'BLIK'
                    WHEN l_suppkey % 4 = 1 THEN ' Card ' WHEN l_suppkey % 4 = 2 THEN 'Cash' ELSE 'Bank Transfer ' END AS payment_mode,
               CASE WHEN l_linestatus = 'O' THEN ' Online' ELSE 'Store ' END AS sales_channel
        FROM lineitem""",
    "b_opportunity": """
        SELECT 'OPP-' || o_orderkey AS Id, o_orderkey % 53 = 0 AS IsDeleted,
               CASE WHEN o_orderkey % 83 = 0 THEN ' ' ELSE 'ACC-' || o_custkey END AS AccountId,
               'Opp ' || o_orderkey AS Name, o_orderpriority AS Description,
               CASE WHEN o_orderkey % 59 = 0 THEN 'Stalled' WHEN o_orderkey % 41 <> 0 THEN
                    CASE o_orderstatus WHEN 'F' THEN 'Closed Won' WHEN 'O' THEN 'Negotiation/Review' ELSE 'Prospecting' END END AS StageName,
               CAST(o_totalprice AS DECIMAL(18,2)) AS Amount,
               CASE WHEN o_orderkey % 67 = 0 THEN CAST(120.0 AS DOUBLE) WHEN o_orderstatus = 'F' THEN 100.0 WHEN o_orderstatus = 'O' THEN 60.0 ELSE 10.0 END AS Probability,
               CAST(o_orderdate AS DATE) AS CloseDate, 'New Business' AS Type, CAST(NULL AS VARCHAR) AS NextStep, 'Web' AS LeadSource,
               o_orderstatus = 'F' AS IsClosed, o_orderstatus = 'F' AS IsWon,
               CASE WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'Pipeline' END AS ForecastCategory,
               'USR-' || (o_custkey % 10) AS OwnerId, o_orderdate - INTERVAL 30 DAY AS CreatedDate, o_orderdate AS LastModifiedDate
        FROM orders""",
    "account_rows": """
        SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "account_changes": changes("account_rows", "c_custkey", "c_custkey % 5 = 0"),
    "account_feed": "SELECT op, seq, ' ACC-' || c_custkey AS Id, CASE WHEN c_custkey % 211 <> 0 THEN FALSE END AS IsDeleted, "
    "' ' || c_name || ' ' AS Name, c_mktsegment AS Type, CASE WHEN c_custkey % 10 = 0 THEN 'ACC-' || (c_custkey // 10) END AS ParentId, "
    + "".join(
        f"' Street ' || c_custkey AS {k}Street, CASE WHEN c_custkey % 29 <> 0 THEN 'City ' || c_nationkey END AS {k}City, n_name AS {k}State, "
        f"lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS {k}PostalCode, r_name AS {k}Country, "
        for k in ("Billing", "Shipping")
    )
    + "CASE WHEN c_custkey % 17 <> 0 THEN '+48 ' || c_custkey || '-' || version END AS Phone, "
    "'https://shop' || c_custkey || '.example.com' AS Website, "
    "CASE WHEN c_custkey % 13 = 1 THEN ' Retail ' WHEN c_custkey % 13 > 1 THEN 'Wholesale' END AS Industry, "
    "CAST(c_acctbal AS DECIMAL(18,2)) AS AnnualRevenue, "
    "CAST(CASE WHEN c_custkey % 103 = 0 THEN -5 ELSE c_custkey % 500 + (version - 1) * 10 END AS INT) AS NumberOfEmployees, "
    "'segment ' || c_mktsegment AS Description FROM account_changes",
    "account_history": history("account_feed", "Id", "a := Phone, b := NumberOfEmployees"),
    "product_rows": """
        SELECT * FROM part JOIN supplier ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier)""",
    "product_changes": changes("product_rows", "p_partkey", "p_partkey % 5 = 0"),
    "product_feed": """
        SELECT op, seq, ' p' || p_partkey || ' ' AS product_id,
               CASE WHEN p_partkey % 71 = 0 THEN '' ELSE p_name END AS product_name,
               CASE p_type WHEN 'STANDARD' THEN 'electronics' WHEN 'ECONOMY' THEN 'mobile' WHEN 'MEDIUM' THEN 'appliances'
                    WHEN 'PROMO' THEN 'furniture' WHEN 'SMALL' THEN 'groceries' ELSE 'oversize' END AS category,
               CASE WHEN p_partkey % 11 <> 0 THEN ' line ' || lower(p_type) END AS subcategory,
               CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS brand,
               CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(p_size AS DECIMAL(4,0)) * CAST(0.1 AS DECIMAL(2,1)) * CAST(version AS DECIMAL(2,0)) AS DECIMAL(12,2)) AS unit_price,
               s_name AS supplier_name,
               CASE WHEN p_partkey % 31 <> 0 THEN CAST(DATE '2020-01-01' + CAST(p_partkey % 1000 AS INT) AS DATE) END AS launch_date,
               CASE WHEN p_partkey % 37 <> 0 THEN seq END AS updated_at
        FROM product_changes""",
    "product_history": history("product_feed", "product_id", "a := unit_price"),
    "inventory_pairs": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
    "b_inventory": """
        SELECT ' inv' || l_partkey || '-' || l_suppkey || ' ' AS inventory_id, 'p' || l_partkey AS product_id, ' s' || l_suppkey AS store_id,
               CAST((l_partkey * l_suppkey) % 50 - 1 + CASE WHEN (l_partkey + l_suppkey) % 4 = 0 THEN 5 ELSE 0 END AS INT) AS stock_quantity,
               10 AS reorder_level,
               CASE WHEN l_suppkey % 23 = 0 THEN ' ' ELSE 'WH-' || (l_suppkey % 5) END AS warehouse_location,
               CASE WHEN l_partkey % 43 <> 0 THEN
                    CASE WHEN (l_partkey + l_suppkey) % 4 = 0 THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-01' END END AS last_stock_update
        FROM inventory_pairs WHERE (l_partkey + l_suppkey) % 97 <> 0""",
    # ------------------------------------------------------------ silver
    "c_transactions": """
        SELECT upper(trim(transaction_id)) AS transaction_id, trim(opportunity_name) AS opportunity_name,
               upper(trim(product_id)) AS product_id, upper(trim(store_id)) AS store_id,
               TRY_CAST(quantity AS INT) AS quantity, CAST(selling_price AS DECIMAL(12,2)) AS selling_price,
               CAST(TRY_CAST(quantity AS INT) * CAST(selling_price AS DECIMAL(12,2)) AS DECIMAL(14,2)) AS gross_amount,
               CAST(discount_amount AS DECIMAL(12,2)) AS discount_amount,
               CAST(TRY_CAST(quantity AS INT) * CAST(selling_price AS DECIMAL(12,2)) - CAST(discount_amount AS DECIMAL(12,2)) AS DECIMAL(14,2)) AS net_amount,
               try_strptime(transaction_timestamp, '%d-%b-%Y %I.%M.%S %p') AS transaction_timestamp,
               trim(payment_mode) AS payment_mode, trim(sales_channel) AS sales_channel
        FROM b_transactions""",
    "s_transactions": f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {SALES_ORDER}) AS rn FROM c_transactions)
        WHERE rn = 1""",
    "s_opportunity": """
        SELECT Id AS id, IsDeleted AS is_deleted, AccountId AS account_id, Name AS name, Description AS description, StageName AS stage_name,
               Amount AS amount,
               CASE WHEN Amount > 100000 THEN 'ENTERPRISE' WHEN Amount > 25000 THEN 'MID_MARKET' ELSE 'SMALL' END AS deal_size,
               Probability AS probability, CloseDate AS close_date, Type AS type, NextStep AS next_step, LeadSource AS lead_source,
               IsClosed AS is_closed, IsWon AS is_won, ForecastCategory AS forecast_category, OwnerId AS owner_id,
               CreatedDate AS created_date, LastModifiedDate AS last_modified_date
        FROM b_opportunity""",
    "s_inventory": """
        SELECT upper(trim(inventory_id)) AS inventory_id, upper(trim(product_id)) AS product_id, upper(trim(store_id)) AS store_id,
               stock_quantity, reorder_level,
               CASE WHEN stock_quantity = 0 THEN 'OUT_OF_STOCK' WHEN stock_quantity <= reorder_level THEN 'LOW_STOCK' ELSE 'HEALTHY' END AS inventory_status,
               trim(warehouse_location) AS warehouse_location, last_stock_update
        FROM b_inventory""",
    "s_product_catalog": f"""
        SELECT upper(trim(product_id)) AS product_id, {title("product_name")} AS product_name, {title("category")} AS category,
               coalesce({title("subcategory")}, 'Unknown') AS subcategory, coalesce({title("brand")}, 'Unknown') AS brand,
               round(unit_price, 2) AS unit_price, {title("supplier_name")} AS supplier_name, launch_date,
               CASE WHEN unit_price >= 3000 THEN 'PREMIUM' WHEN unit_price >= 500 THEN 'MID_RANGE' ELSE 'BUDGET' END AS product_segment,
               __START_AT AS start_at, __END_AT AS end_at, __END_AT IS NULL AS is_active, updated_at
        FROM product_history""",
    "s_account": "SELECT trim(Id) AS id, IsDeleted AS is_deleted, trim(Name) AS customer_name, trim(Type) AS type, ParentId AS parent_id, "
    + "".join(f"trim({k}{p}) AS {k.lower()}_{SNAKE[p]}, " for k in ("Billing", "Shipping") for p in ADDRESS)
    + "trim(Phone) AS phone, trim(Website) AS website, coalesce(trim(Industry), 'Unknown') AS industry, AnnualRevenue AS annual_revenue, "
    "NumberOfEmployees AS number_of_employees, trim(Description) AS description, __START_AT AS start_at, __END_AT AS end_at, "
    "__END_AT IS NULL AS is_active FROM account_history",
    # -------------------------------------------------------------- gold
    "dim_customer": """
        SELECT id AS customer_id, customer_name, type AS customer_type, billing_city, billing_state, billing_country, phone, website,
               industry, CAST(annual_revenue AS DECIMAL(38,20)) AS annual_revenue, number_of_employees, description
        FROM v_account WHERE is_active AND NOT is_deleted""",
    "dim_product": """
        SELECT product_id, product_name, category, subcategory, brand, product_segment, unit_price, supplier_name, launch_date, updated_at
        FROM v_product_catalog WHERE is_active""",
    "dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS full_date, year(d) AS year, quarter(d) AS quarter,
               'Q' || quarter(d) AS quarter_name, month(d) AS month, strftime(d, '%B') AS month_name, strftime(d, '%b %Y') AS month_year,
               year(d) * 100 + month(d) AS month_year_sort, CAST(date_trunc('month', d) AS DATE) AS month_start, weekofyear(d) AS week_of_year,
               day(d) AS day, strftime(d, '%A') AS day_name, isodow(d) AS day_of_week_sort, isodow(d) IN (6, 7) AS is_weekend
        FROM (SELECT unnest(generate_series(s, e, INTERVAL 1 DAY)) AS d FROM (
            SELECT date_trunc('year', min(l_shipdate)) AS s, make_date(year(max(l_shipdate)), 12, 31) AS e FROM lineitem))""",
    "fact_sales": """
        SELECT t.transaction_id, CAST(strftime(t.transaction_timestamp, '%Y%m%d') AS INT) AS date_key, o.account_id AS customer_id,
               t.product_id, t.store_id, t.quantity, t.selling_price, t.discount_amount, t.net_amount AS net_sales_amount,
               t.payment_mode, t.sales_channel
        FROM v_transactions t LEFT JOIN v_opportunity o ON upper(trim(t.opportunity_name)) = upper(trim(o.name))""",
}


def chunks(source: str) -> str:
    """120-word windows, 100 words apart."""
    return f"""
        SELECT document_id || '_' || i AS chunk_id, CAST(i AS INT) AS chunk_position, piece AS chunk_to_retrieve,
               concat_ws(': ', category, piece) AS chunk_to_embed,
               '{{"chunks":' || n_chunks || ',"start_word":' || (i * 100) || '}}' AS metadata,
               source AS source_uri, document_type, product_id, category, product_segment
        FROM (SELECT *, array_to_string(w[i * 100 + 1 : i * 100 + 120], ' ') AS piece FROM (
            SELECT *, unnest(range(n_chunks)) AS i FROM (
                SELECT *, CASE WHEN len(w) = 0 THEN 0 ELSE greatest(CAST(ceil((len(w) - 120) / 100.0) AS BIGINT), 0) + 1 END AS n_chunks FROM (
                    SELECT *, list_filter(regexp_split_to_array(content, '[ \\t\\r\\n]+'), lambda x: x <> '') AS w FROM {source}))))"""


def term_rows(source: str, key: str, text: str) -> str:
    return (
        f"SELECT {key} AS id, unnest(list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), "
        f"lambda x: x <> '')) AS term FROM {source}"
    )


def page_text() -> str:
    x = "html"
    for pattern in (
        r"(?is)<script\b.*?</script\s*>",
        r"(?is)<style\b.*?</style\s*>",
        r"(?is)<(?:nav|header|footer)\b.*?</(?:nav|header|footer)\s*>",
        r"(?is)<!--.*?-->",
        r"(?is)<[^>]*>",
    ):
        x = f"regexp_replace({x}, '{pattern}', ' ', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return f"trim(regexp_replace({x}, '[ \\t\\r\\n]+', ' ', 'g'))"


NO_PRODUCT = "CAST(NULL AS VARCHAR) AS product_id, CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS product_segment"
PRODUCT_TEXT = " || chr(10) || ".join(
    f"'{label}: ' || coalesce(CAST({column} AS VARCHAR), 'Unknown')"
    for label, column in (
        ("Product ID", "p.product_id"), ("Product Name", "product_name"), ("Category", "category"),
        ("Subcategory", "subcategory"), ("Brand", "brand"), ("Unit Price", "unit_price"),
        ("Supplier", "supplier_name"), ("Product Segment", "product_segment"), ("Launch Date", "launch_date"),
        ("Total Units Sold", "coalesce(total_units_sold, 0)"),
        ("Total Net Sales", "CAST(coalesce(total_net_sales, 0) AS DECIMAL(38,2))"),
        ("Transaction Count", "coalesce(transaction_count, 0)"),
    )
)


def product_texts(products: str) -> str:
    return f"""
        SELECT 'product_' || p.product_id AS document_id, 'product' AS document_type, 'gold.dim_product' AS source,
               p.product_id AS product_id, category, product_segment, {PRODUCT_TEXT} AS content
        FROM {products} p LEFT JOIN sales_summary s ON p.product_id = s.product_id"""


RELATIONS |= {
    "sales_summary": """
        SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_units_sold, sum(net_sales_amount) AS total_net_sales,
               count(DISTINCT transaction_id) AS transaction_count FROM fact_sales GROUP BY product_id""",
    "d_product": product_texts("dim_product"),
    "d_page": f"SELECT 'page_' || sha256(url) AS document_id, 'page' AS document_type, url AS source, {NO_PRODUCT}, {page_text()} AS content FROM pages",
    "d_text": f"SELECT 'text_' || doc_id AS document_id, 'text' AS document_type, source, {NO_PRODUCT}, text AS content FROM documents",
    "k_product": chunks("d_product"),
    "k_page": chunks("d_page"),
    "k_text": chunks("d_text"),
    "k_rag": "SELECT * FROM k_product UNION ALL SELECT * FROM k_page",
}


def search(chunk_relation: str, depth: int) -> dict[str, str]:
    """Keyword, vector and fused rankings of the benchmark texts."""
    c = chunk_relation
    top = "row_number() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_id) AS rank"
    weigh = f"""
        SELECT id, slot, CAST(count(*) AS DOUBLE) * any_value(idf) AS w
        FROM (SELECT id, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 256 AS slot FROM {{0}}) JOIN {c}_slots USING (slot) GROUP BY id, slot"""
    return {
        f"{c}_terms": term_rows(c, "chunk_id", "chunk_to_retrieve"),
        f"{c}_eterms": term_rows(c, "chunk_id", "chunk_to_embed"),
        "q_terms": term_rows("benchmark", "item_id", "text"),
        f"{c}_tf": f"SELECT id, term, count(*) AS tf FROM {c}_terms GROUP BY 1, 2",
        f"{c}_len": f"SELECT id, count(*) AS dl FROM {c}_terms GROUP BY 1",
        f"{c}_n": f"SELECT (SELECT count(*) FROM {c}) AS n, (SELECT count(*) FROM {c}_terms) / CAST((SELECT count(*) FROM {c}) AS DOUBLE) AS avgdl",
        f"{c}_df": f"SELECT term, count(*) AS df FROM {c}_tf GROUP BY 1",
        f"{c}_bm25": f"""
            SELECT question_id, chunk_id, score, {top} FROM (
                SELECT q.id AS question_id, t.id AS chunk_id,
                       round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))), 6) AS score
                FROM (SELECT DISTINCT id, term FROM q_terms) q JOIN {c}_tf t ON q.term = t.term JOIN {c}_df d ON d.term = t.term
                JOIN {c}_len l ON l.id = t.id, {c}_n GROUP BY 1, 2) QUALIFY rank <= {depth}""",
        f"{c}_slots": f"""
            SELECT slot, ln((any_value(n) + 1.0) / (count(*) + 1.0)) AS idf FROM (
                SELECT DISTINCT id, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 256 AS slot FROM {c}_eterms), {c}_n GROUP BY slot""",
        f"{c}_dw": weigh.format(f"{c}_eterms"),
        f"{c}_qw": weigh.format("q_terms"),
        f"{c}_dnorm": f"SELECT id, sqrt(sum(w * w)) AS norm FROM {c}_dw GROUP BY id",
        f"{c}_qnorm": f"SELECT id, sqrt(sum(w * w)) AS norm FROM {c}_qw GROUP BY id",
        f"{c}_vector": f"""
            SELECT question_id, chunk_id, score, {top} FROM (
                SELECT q.id AS question_id, d.id AS chunk_id, round(sum(q.w * d.w) / (any_value(qn.norm) * any_value(dn.norm)), 6) AS score
                FROM {c}_qw q JOIN {c}_dw d ON q.slot = d.slot JOIN {c}_qnorm qn ON qn.id = q.id JOIN {c}_dnorm dn ON dn.id = d.id
                GROUP BY 1, 2) QUALIFY rank <= {depth}""",
        f"{c}_hybrid": f"""
            SELECT question_id, chunk_id, score, {top} FROM (
                SELECT question_id, chunk_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score
                FROM (SELECT * FROM {c}_vector UNION ALL SELECT * FROM {c}_bm25) GROUP BY 1, 2) QUALIFY rank <= 10""",
    }


RELATIONS |= search("k_text", 50) | search("k_rag", 50)
for _d in RULES:
    RELATIONS[f"v_{_d}"] = f"SELECT * FROM s_{_d} WHERE {ok(_d)}"
    RELATIONS[f"q_{_d}"] = f"SELECT * FROM s_{_d} WHERE NOT ({ok(_d)})"


def with_sql(body: str) -> str:
    """``body`` with a WITH clause of every named relation it uses."""
    order: list[str] = []

    def need(text: str) -> None:
        for word in re.findall(r"\b[a-z_]\w*\b", text):
            if word in RELATIONS and word not in order:
                need(RELATIONS[word])
                if word not in order:
                    order.append(word)

    need(body)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{name} AS ({RELATIONS[name]})" for name in order)
    return f"WITH {ctes}\n{body.strip()}"
