"""Predefined lineage entries.

Fixed values: ids, names, types, fields, owners, pipelines and confidence of
the registry, stated as they must appear in the lineage reports. The wording of
locations, descriptions, rules and logic describes this package.
"""

from __future__ import annotations

_ENG = "Data Engineering"
CSV, API, DOCS, STAR = (
    "csv_ingestion_pipeline", "api_ingestion_pipeline", "firestore_ingestion_pipeline", "transformation_dag",
)
CSV_NAME, API_NAME, DOCS_NAME, STAR_NAME = (
    "CSV Ingestion Pipeline", "API Ingestion Pipeline", "Firestore Ingestion Pipeline", "Data Warehouse Transformation",
)

# source_id, source_name, source_type, source_location, description, business_owner, technical_owner
SOURCES = [
    ("SRC_CSV_CUSTOMERS", "Customer CSV Files", "CSV", "raw/customers", "Customer files as delivered", "Business Team", _ENG),
    ("SRC_API_PRODUCTS", "Products REST API", "API", "raw/products", "Catalogue pages as landed", "Product Team", _ENG),
    ("SRC_FIRESTORE_CAMPAIGNS", "Marketing Campaigns", "FIRESTORE", "marketing_campaigns", "Exported campaign documents", "Marketing Team", _ENG),
    ("SRC_FIRESTORE_TRANSACTIONS", "Sales Transactions", "FIRESTORE", "sales_transactions", "Exported sales documents", "Sales Team", _ENG),
]

# target_id, target_name, target_type, dataset_name, table_name, description, business_purpose
TARGETS = [
    ("TGT_STAGING_CUSTOMERS", "Staging Customers", "STAGING_TABLE", "staging_area", "customers", "Customers as ingested", "Staging"),
    ("TGT_STAGING_PRODUCTS", "Staging Products", "STAGING_TABLE", "staging_area", "products", "Products as ingested", "Staging"),
    ("TGT_STAGING_CAMPAIGNS", "Staging Campaigns", "STAGING_TABLE", "staging_area", "marketing_campaigns", "Campaigns as ingested", "Staging"),
    ("TGT_STAGING_TRANSACTIONS", "Staging Transactions", "STAGING_TABLE", "staging_area", "sales_transactions", "Sales as ingested", "Staging"),
    ("TGT_DIM_CUSTOMERS", "Customer Dimension", "DIMENSION_TABLE", "data_warehouse", "dim_customers", "One row per valid customer", "Customer reports"),
    ("TGT_DIM_PRODUCTS", "Product Dimension", "DIMENSION_TABLE", "data_warehouse", "dim_products", "One row per product", "Product reports"),
    ("TGT_DIM_CAMPAIGNS", "Campaign Dimension", "DIMENSION_TABLE", "data_warehouse", "dim_campaigns", "One row per campaign", "Campaign reports"),
    ("TGT_FACT_TRANSACTIONS", "Sales Fact Table", "FACT_TABLE", "data_warehouse", "fact_sales_transactions", "One row per kept sale", "Sales reports"),
]

# transformation_id, transformation_name, transformation_type, source_field, target_field,
# transformation_logic, business_rule, dag_id, task_id
TRANSFORMATIONS = [
    ("TRANS_CUST_001", "Customer Data Ingestion", "INGESTION", "customer_id", "customer_id", "DIRECT_COPY", "key kept as delivered", CSV, "load_to_bigquery"),
    ("TRANS_CUST_002", "Customer Email Ingestion", "INGESTION", "email", "email", "DIRECT_COPY", "email kept as delivered", CSV, "load_to_bigquery"),
    ("TRANS_CUST_003", "Customer Metadata Addition", "ENRICHMENT", "NULL", "ingestion_timestamp", "current_timestamp", "load time recorded", CSV, "validate_transform"),
    ("TRANS_PROD_001", "Product Data Ingestion", "INGESTION", "product_id", "product_id", "DIRECT_COPY", "key kept as delivered", API, "load_to_bigquery"),
    ("TRANS_PROD_002", "Product Price Validation", "CLEANING", "price", "price", "price where positive, else 0", "no negative prices", API, "validate_transform_api"),
    ("TRANS_PROD_003", "Product API Metadata", "ENRICHMENT", "NULL", "api_source", "CONSTANT_VALUE", "origin recorded", API, "validate_transform_api"),
    ("TRANS_CAMP_001", "Campaign Data Ingestion", "INGESTION", "campaign_id", "campaign_id", "DIRECT_COPY", "key kept as delivered", DOCS, "load_campaigns_to_bigquery"),
    ("TRANS_CAMP_002", "Campaign Timestamp Conversion", "CLEANING", "start_date", "start_date", "to_timestamp", "dates are timestamps", DOCS, "validate_transform_campaigns"),
    ("TRANS_CAMP_003", "Campaign Source Tracking", "ENRICHMENT", "NULL", "source_collection", "CONSTANT_VALUE", "origin recorded", DOCS, "validate_transform_campaigns"),
    ("TRANS_TRANS_001", "Transaction Data Ingestion", "INGESTION", "transaction_id", "transaction_id", "DIRECT_COPY", "key kept as delivered", DOCS, "load_transactions_to_bigquery"),
    ("TRANS_TRANS_002", "Transaction Amount Validation", "CLEANING", "amount", "amount", "amount where not negative, else 0", "no negative amounts", DOCS, "validate_transform_transactions"),
    ("TRANS_TRANS_003", "Campaign ID Null Handling", "CLEANING", "campaign_id", "campaign_id", "empty text for null", "sales without campaign load", DOCS, "validate_transform_transactions"),
    ("TRANS_DIM_CUST_001", "Customer Name Standardization", "CLEANING", "first_name", "first_name", "trimmed title case", "one spelling of names", STAR, "transform_dim_customers"),
    ("TRANS_DIM_CUST_002", "Customer Email Validation", "CLEANING", "email", "email_valid", "address pattern holds", "valid email flagged", STAR, "transform_dim_customers"),
    ("TRANS_DIM_CUST_003", "Customer Deduplication", "CLEANING", "customer_id", "customer_id", "best row per key", "one row per customer", STAR, "transform_dim_customers"),
    ("TRANS_DIM_PROD_001", "Product Price Currency Conversion", "CLEANING", "price", "price", "price times EUR rate", "prices in EUR", STAR, "transform_dim_products"),
    ("TRANS_DIM_PROD_002", "Product Rating Validation", "CLEANING", "rating", "rating", "rating within 0 and 5", "ratings in range", STAR, "transform_dim_products"),
    ("TRANS_DIM_PROD_003", "Product Category Standardization", "CLEANING", "category", "category", "trimmed upper case", "one spelling of categories", STAR, "transform_dim_products"),
    ("TRANS_DIM_CAMP_001", "Campaign Budget Validation", "CLEANING", "budget", "budget", "budget where not negative, else 0", "no negative budgets", STAR, "transform_dim_campaigns"),
    ("TRANS_DIM_CAMP_002", "Campaign Duration Calculation", "ENRICHMENT", "start_date,end_date", "campaign_duration_days", "days between both dates", "duration known", STAR, "transform_dim_campaigns"),
    ("TRANS_DIM_CAMP_003", "Campaign Performance Calculation", "ENRICHMENT", "actual_spend,budget", "spend_percentage", "spend as percent of budget", "budget use known", STAR, "transform_dim_campaigns"),
    ("TRANS_FACT_001", "Transaction Foreign Key Validation", "CLEANING", "customer_id,product_id,campaign_id", "customer_exists,product_exists,campaign_exists", "key found in dimension", "foreign keys hold", STAR, "transform_fact_transactions"),
    ("TRANS_FACT_002", "Transaction Amount Calculation", "CLEANING", "quantity,unit_price,discount,tax", "calculated_total_amount", "gross less discount plus tax", "amounts verified", STAR, "transform_fact_transactions"),
    ("TRANS_FACT_003", "Transaction Quality Filtering", "FILTERING", "status", "status", "completed or pending", "only sales that count", STAR, "transform_fact_transactions"),
]

# relationship_id, source_id, target_id, transformation_id, relationship_type, confidence_score,
# pipeline_name, dag_id, task_id
RELATIONSHIPS = [
    ("REL_001", "SRC_CSV_CUSTOMERS", "TGT_STAGING_CUSTOMERS", "TRANS_CUST_001", "DIRECT_COPY", 1.0, CSV_NAME, CSV, "load_to_bigquery"),
    ("REL_002", "SRC_API_PRODUCTS", "TGT_STAGING_PRODUCTS", "TRANS_PROD_001", "TRANSFORMED", 0.95, API_NAME, API, "load_to_bigquery"),
    ("REL_003", "SRC_FIRESTORE_CAMPAIGNS", "TGT_STAGING_CAMPAIGNS", "TRANS_CAMP_001", "TRANSFORMED", 0.95, DOCS_NAME, DOCS, "load_campaigns_to_bigquery"),
    ("REL_004", "SRC_FIRESTORE_TRANSACTIONS", "TGT_STAGING_TRANSACTIONS", "TRANS_TRANS_001", "TRANSFORMED", 0.90, DOCS_NAME, DOCS, "load_transactions_to_bigquery"),
    ("REL_005", "TGT_STAGING_CUSTOMERS", "TGT_DIM_CUSTOMERS", "TRANS_DIM_CUST_003", "TRANSFORMED", 0.98, STAR_NAME, STAR, "transform_dim_customers"),
    ("REL_006", "TGT_STAGING_PRODUCTS", "TGT_DIM_PRODUCTS", "TRANS_DIM_PROD_003", "TRANSFORMED", 0.95, STAR_NAME, STAR, "transform_dim_products"),
    ("REL_007", "TGT_STAGING_CAMPAIGNS", "TGT_DIM_CAMPAIGNS", "TRANS_DIM_CAMP_003", "TRANSFORMED", 0.95, STAR_NAME, STAR, "transform_dim_campaigns"),
    ("REL_008", "TGT_STAGING_TRANSACTIONS", "TGT_FACT_TRANSACTIONS", "TRANS_FACT_003", "FILTERED", 0.85, STAR_NAME, STAR, "transform_fact_transactions"),
]

# Relationships captured at run time: source_id, target_id, transformation_id, type, confidence, pipeline
CAPTURES = {
    "customers": ("SRC_CSV_CUSTOMERS", "TGT_STAGING_CUSTOMERS", "TRANS_CUST_001", "DIRECT_COPY", 1.0, CSV_NAME),
    "products": ("SRC_API_PRODUCTS", "TGT_STAGING_PRODUCTS", "TRANS_PROD_001", "TRANSFORMED", 0.95, API_NAME),
    "marketing_campaigns": ("SRC_FIRESTORE_CAMPAIGNS", "TGT_STAGING_CAMPAIGNS", "TRANS_CAMP_001", "TRANSFORMED", 0.95, DOCS_NAME),
    "sales_transactions": ("SRC_FIRESTORE_TRANSACTIONS", "TGT_STAGING_TRANSACTIONS", "TRANS_TRANS_001", "TRANSFORMED", 0.90, DOCS_NAME),
    "dim_customers": ("TGT_STAGING_CUSTOMERS", "TGT_DIM_CUSTOMERS", "TRANS_DIM_CUST_003", "TRANSFORMED", 0.98, STAR_NAME),
    "dim_products": ("TGT_STAGING_PRODUCTS", "TGT_DIM_PRODUCTS", "TRANS_DIM_PROD_003", "TRANSFORMED", 0.98, STAR_NAME),
    "dim_campaigns": ("TGT_STAGING_CAMPAIGNS", "TGT_DIM_CAMPAIGNS", "TRANS_DIM_CAMP_003", "TRANSFORMED", 0.98, STAR_NAME),
    "fact_sales_transactions": ("TGT_STAGING_TRANSACTIONS", "TGT_FACT_TRANSACTIONS", "TRANS_FACT_003", "TRANSFORMED", 0.98, STAR_NAME),
}
