"""Oracle SQL of feeds that went through files."""

from oracles.analytics import a8
from oracles.base import sql

_MONEY = ("unit_price", "amount", "discount_amount", "tax_amount")
_SALES = ", ".join(f"{m}::DOUBLE AS {m}" for m in _MONEY)

ORACLES = {
    "s1_latest_csv": sql("SELECT * FROM stg_customers", "stg_customers"),
    "s2_api_pages": sql("SELECT * REPLACE (price::DOUBLE AS price) FROM stg_products", "stg_products"),
    "s3_campaign_documents": sql(
        """SELECT * EXCLUDE (created_date) REPLACE (budget::DOUBLE AS budget, actual_spend::DOUBLE AS actual_spend,
  strftime(start_date, '%Y-%m-%dT00:00:00.000000') AS start_date,
  strftime(end_date, '%Y-%m-%dT00:00:00.000000') AS end_date)
FROM stg_campaigns WHERE status IS NOT NULL""",
        "stg_campaigns",
    ),
    "s4_newest_per_status": sql(
        f"""SELECT * EXCLUDE (created_date, updated_date) REPLACE ({_SALES}, ifnull(campaign_id, '') AS campaign_id)
FROM stg_sales WHERE status IN ('completed', 'pending', 'cancelled')""",
        "stg_sales",
    ),
    "s5_contract_report": sql(
        """SELECT TRUE AS valid, '' AS missing_columns, 'source_file' AS extra_columns, count(*) AS record_count
FROM stg_customers""",
        "stg_customers",
    ),
    "s6_json_keys": """
SELECT key AS required_key, (SELECT count(*) FROM events) AS record_count,
  (SELECT count(*) FROM events WHERE NOT list_contains(json_keys(props), key)) AS missing_count
FROM (VALUES ('k'), ('source')) v(key)""",
    "s6_first_record": """
WITH first AS (SELECT json_keys(arg_min(props, event_id)) AS keys, count(*) AS record_count FROM events),
lacking AS (
  SELECT record_count, (SELECT coalesce(string_agg(key, ',' ORDER BY pos), '')
    FROM (VALUES (1, 'k'), (2, 'source')) v(pos, key) WHERE NOT list_contains(keys, key)) AS missing_keys FROM first
)
SELECT missing_keys = '' AND record_count > 0 AS valid, missing_keys, record_count FROM lacking""",
    "s13_documents": sql(
        f"SELECT * EXCLUDE (created_date, updated_date) REPLACE ({_SALES}) FROM stg_sales", "stg_sales"
    ),
    "s15_s16_staging_modes": sql(
        """SELECT 'customers' AS table_name, 'append' AS mode, 2 * count(*) AS record_count FROM stg_customers
UNION ALL SELECT 'products', 'overwrite', count(*) FROM stg_products""",
        "stg_customers", "stg_products",
    ),
    "s18_partitioned_write": sql(
        """SELECT transaction_date, count(*) AS transactions, sum(amount)::DOUBLE AS revenue FROM fact GROUP BY 1""",
        "fact",
    ),
    "s18_clustered_read": sql(
        """SELECT 'product' AS filtered, transaction_id, amount::DOUBLE AS amount FROM fact WHERE product_id BETWEEN '10' AND '19'
UNION ALL SELECT 'customer', transaction_id, amount::DOUBLE FROM fact WHERE customer_id BETWEEN '10' AND '19'""",
        "fact",
    ),
    "l13_l14_tracked_feeds": sql(
        """SELECT source_table, 'SUCCESS' AS execution_status, n AS records_processed, TRUE AS lineage_captured, 1 AS captures
FROM (SELECT 'customers' AS source_table, count(*) AS n FROM stg_customers
UNION ALL SELECT 'products', count(*) FROM stg_products
UNION ALL SELECT 'marketing_campaigns', count(*) FROM stg_campaigns
UNION ALL SELECT 'sales_transactions', count(*) FROM stg_sales)""",
        "stg_customers", "stg_products", "stg_campaigns", "stg_sales",
    ),
    "s22_export": a8,
    "s24_ingestion_events": sql(
        """SELECT 'customers' AS source, 'raw' AS layer, 'SUCCESS' AS status, count(*) AS record_count FROM stg_customers
UNION ALL SELECT 'products', 'raw', 'SUCCESS', count(*) FROM stg_products
UNION ALL SELECT 'marketing_campaigns', 'raw', 'SUCCESS', count(*) FROM stg_campaigns
UNION ALL SELECT 'sales_transactions', 'raw', 'SUCCESS', count(*) FROM stg_sales""",
        "stg_customers", "stg_products", "stg_campaigns", "stg_sales",
    ),
}
