"""Column contracts of the tables, as DDL.

Fixed values: names, order and types are what sources deliver and what readers
of the tables rely on.
"""

import re

BRONZE_TRANSACTIONS = """
    transaction_id STRING, opportunity_name STRING, product_id STRING,
    store_id STRING, quantity INT, selling_price DECIMAL(10,2),
    discount_amount DECIMAL(10,2), transaction_timestamp STRING,
    payment_mode STRING, sales_channel STRING
"""

BRONZE_ACCOUNT = """
    Id STRING, IsDeleted BOOLEAN, Name STRING, Type STRING, ParentId STRING,
    BillingStreet STRING, BillingCity STRING, BillingState STRING,
    BillingPostalCode STRING, BillingCountry STRING, ShippingStreet STRING,
    ShippingCity STRING, ShippingState STRING, ShippingPostalCode STRING,
    ShippingCountry STRING, Phone STRING, Website STRING, Industry STRING,
    AnnualRevenue DECIMAL(18,2), NumberOfEmployees INT, Description STRING,
    __START_AT TIMESTAMP, __END_AT TIMESTAMP
"""

BRONZE_OPPORTUNITY = """
    Id STRING, IsDeleted BOOLEAN, AccountId STRING, Name STRING,
    Description STRING, StageName STRING, Amount DECIMAL(18,2),
    Probability DOUBLE, CloseDate DATE, Type STRING, NextStep STRING,
    LeadSource STRING, IsClosed BOOLEAN, IsWon BOOLEAN,
    ForecastCategory STRING, OwnerId STRING, CreatedDate TIMESTAMP,
    LastModifiedDate TIMESTAMP
"""

BRONZE_PRODUCT_CATALOG = """
    product_id STRING, product_name STRING, category STRING,
    subcategory STRING, brand STRING, unit_price DECIMAL(12,2),
    supplier_name STRING, launch_date DATE, __START_AT TIMESTAMP,
    __END_AT TIMESTAMP, updated_at TIMESTAMP
"""

BRONZE_INVENTORY = """
    inventory_id STRING, product_id STRING, store_id STRING,
    stock_quantity INT, reorder_level INT, warehouse_location STRING,
    last_stock_update TIMESTAMP
"""

DIM_CUSTOMER = """
    customer_id STRING, customer_name STRING, customer_type STRING,
    billing_city STRING, billing_state STRING, billing_country STRING,
    phone STRING, website STRING, industry STRING,
    annual_revenue DECIMAL(38,20), number_of_employees INT, description STRING
"""

DIM_PRODUCT = """
    product_id STRING, product_name STRING, category STRING,
    subcategory STRING, brand STRING, product_segment STRING,
    unit_price DECIMAL(13,2), supplier_name STRING, launch_date DATE,
    updated_at TIMESTAMP
"""

DIM_DATE = """
    date_key INT, full_date DATE, year INT, quarter INT, quarter_name STRING,
    month INT, month_name STRING, month_year STRING, month_year_sort INT,
    month_start DATE, week_of_year INT, day INT, day_name STRING,
    day_of_week_sort INT, is_weekend BOOLEAN
"""

FACT_SALES = """
    transaction_id STRING, date_key INT, customer_id STRING,
    product_id STRING, store_id STRING, quantity INT,
    selling_price DECIMAL(12,2), discount_amount DECIMAL(12,2),
    net_sales_amount DECIMAL(14,2), payment_mode STRING, sales_channel STRING
"""

RAG_CHUNKS = """
    chunk_id STRING, chunk_position INT, chunk_to_retrieve STRING,
    chunk_to_embed STRING, metadata STRING, source_uri STRING,
    document_type STRING, product_id STRING, category STRING,
    product_segment STRING
"""


def names(ddl: str) -> tuple[str, ...]:
    """Column names of a contract, in order."""
    return tuple(part.split()[0] for part in re.sub(r"\(\d+,\d+\)", "", ddl).split(","))
