"""Schemas and name contracts of the four feeds and of the result tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _B, _TS, _DATE = (
    T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType(), T.DateType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Columns and types of the feeds, as delivered.
CUSTOMERS = _struct(
    customer_id=_S, first_name=_S, last_name=_S, email=_S, phone=_S, address=_S,
    city=_S, country=_S, registration_date=_DATE, age=_L,
)
PRODUCTS = _struct(
    product_id=_S, name=_S, category=_S, subcategory=_S, brand=_S, price=_D, currency=_S,
    description=_S, availability=_B, stock_quantity=_L, rating=_D, reviews_count=_L,
    weight_kg=_D, country_origin=_S,
)
CAMPAIGNS = _struct(
    campaign_id=_S, name=_S, channel=_S, status=_S, target_audience=_S, budget=_D,
    actual_spend=_D, conversion_rate=_D, impressions=_L, clicks=_L, conversions=_L,
    start_date=_TS, end_date=_TS, created_date=_TS, updated_date=_TS, document_id=_S,
)
TRANSACTIONS = _struct(
    transaction_id=_S, customer_id=_S, product_id=_S, campaign_id=_S, quantity=_L,
    unit_price=_D, amount=_D, discount_amount=_D, tax_amount=_D, transaction_date=_TS,
    status=_S, payment_method=_S, shipping_address=_S, order_notes=_S,
    created_date=_TS, updated_date=_TS, document_id=_S,
)
PRODUCT_PAGE = T.StructType([
    T.StructField("page", _L),
    T.StructField("status", _S),
    T.StructField("data", T.ArrayType(PRODUCTS)),
    T.StructField("pagination", _struct(has_next=_B)),
])

# The column names each feed must deliver.
REQUIRED = {
    "customers": [
        "customer_id", "first_name", "last_name", "email", "phone", "address", "city", "country",
        "registration_date", "age",
    ],
    "products": ["product_id", "name", "category", "price"],
    "marketing_campaigns": [
        "campaign_id", "name", "start_date", "end_date", "budget", "channel", "status",
        "target_audience", "conversion_rate", "created_date", "updated_date",
    ],
    "sales_transactions": [
        "transaction_id", "customer_id", "product_id", "campaign_id", "amount", "quantity",
        "unit_price", "discount_amount", "tax_amount", "transaction_date", "status",
        "payment_method", "shipping_address", "order_notes", "created_date", "updated_date",
    ],
}

# Columns added at ingestion.
METADATA = {
    "customers": _struct(ingestion_timestamp=_TS, source_file=_S),
    "products": _struct(ingestion_timestamp=_TS, api_source=_S, extraction_timestamp=_TS),
    "marketing_campaigns": _struct(ingestion_timestamp=_TS, source_collection=_S),
    "sales_transactions": _struct(ingestion_timestamp=_TS, source_collection=_S),
}

FEEDS = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "marketing_campaigns": CAMPAIGNS,
    "sales_transactions": TRANSACTIONS,
}
STAGING = {name: T.StructType(FEEDS[name].fields + METADATA[name].fields) for name in FEEDS}

# Names of the warehouse tables.
WAREHOUSE_TABLES = ["dim_customers", "dim_products", "dim_campaigns", "fact_sales_transactions"]

# Columns and types of the result, lineage, log and event tables.
QUALITY_RESULTS = _struct(
    table_name=_S, check_type=_S, check_status=_S, check_timestamp=_TS, metric_value=_D,
    threshold_value=_D, status_description=_S, recommended_action=_S,
)
LINEAGE_SOURCES = _struct(
    source_id=_S, source_name=_S, source_type=_S, source_location=_S, description=_S,
    business_owner=_S, technical_owner=_S, created_timestamp=_TS, last_updated=_TS,
)
LINEAGE_TARGETS = _struct(
    target_id=_S, target_name=_S, target_type=_S, dataset_name=_S, table_name=_S,
    description=_S, business_purpose=_S, created_timestamp=_TS, last_updated=_TS,
)
LINEAGE_TRANSFORMATIONS = _struct(
    transformation_id=_S, transformation_name=_S, transformation_type=_S, source_field=_S,
    target_field=_S, transformation_logic=_S, business_rule=_S, dag_id=_S, task_id=_S,
    created_timestamp=_TS,
)
LINEAGE_RELATIONSHIPS = _struct(
    relationship_id=_S, source_id=_S, target_id=_S, transformation_id=_S, relationship_type=_S,
    confidence_score=_D, pipeline_name=_S, dag_id=_S, task_id=_S, execution_date=_TS,
    created_timestamp=_TS, is_active=_B,
)
EXECUTION_LOG = _struct(
    execution_id=_S, dag_id=_S, task_id=_S, run_id=_S, source_table=_S, target_table=_S,
    records_processed=_L, execution_status=_S, start_time=_TS, end_time=_TS,
    execution_duration_seconds=_L, error_message=_S, lineage_captured=_B, created_timestamp=_TS,
)
PIPELINE_RUNS = _struct(
    run_id=_S, started=_TS, duration_seconds=_D, staging_records=_L, warehouse_records=_L, health=_S, log_errors=_L,
)
INGESTION_EVENTS = _struct(
    timestamp=_TS, source=_S, layer=_S, status=_S, record_count=_L, error=_S,
)
