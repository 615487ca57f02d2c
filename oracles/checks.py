"""Oracle SQL of the quality checks, validation queries and gates.

Fixed values: check names, status texts and limits.
"""

from oracles.base import AS_OF, cents, cte, half_up, mean, sql

NOW = "TIMESTAMP '2001-11-05 12:00:00'"
_ALL = ("customers_dim", "products_dim", "campaigns_dim", "fact")

cte("key_counts", list(_ALL), """
SELECT 'dim_customers' AS t, customer_id AS k, count(*) AS n FROM customers_dim GROUP BY 2
UNION ALL SELECT 'dim_products', product_id, count(*) FROM products_dim GROUP BY 2
UNION ALL SELECT 'dim_campaigns', campaign_id, count(*) FROM campaigns_dim GROUP BY 2
UNION ALL SELECT 'fact_sales_transactions', transaction_id, count(*) FROM fact GROUP BY 2
UNION ALL SELECT 'dim_customers_email', email, count(*) FROM customers_dim WHERE email IS NOT NULL GROUP BY 2""")

cte("raw_key_counts", ["stg_customers", "stg_products", "stg_campaigns", "stg_sales"], """
SELECT 'customers' AS t, customer_id AS k, count(*) AS n FROM stg_customers GROUP BY 2
UNION ALL SELECT 'products', product_id, count(*) FROM stg_products GROUP BY 2
UNION ALL SELECT 'marketing_campaigns', campaign_id, count(*) FROM stg_campaigns GROUP BY 2
UNION ALL SELECT 'sales_transactions', transaction_id, count(*) FROM stg_sales GROUP BY 2
UNION ALL SELECT 'customers_email', email, count(*) FROM stg_customers WHERE email IS NOT NULL GROUP BY 2""")


def _unique(counts: str, where: str = "TRUE") -> str:
    return f"""
SELECT t AS table_name, count(*) AS violation_count, sum(n)::BIGINT AS total_duplicates,
  'UNIQUENESS_CHECK' AS check_type, 'FAIL' AS check_status
FROM {counts} WHERE n > 1 AND {where} GROUP BY t
UNION ALL
SELECT 'ALL_TABLES', 0, 0, 'UNIQUENESS_CHECK', 'PASS'
WHERE NOT EXISTS (FROM {counts} WHERE n > 1 AND {where})"""


cte("q1", ["key_counts"], _unique("key_counts"))

cte("filled", list(_ALL), """
SELECT 'dim_customers' AS table_name, count(*) AS n,
  count(customer_id) + count(first_name) + count(last_name) + count(email) + count(country) AS cells
FROM customers_dim
UNION ALL SELECT 'dim_products', count(*),
  count(product_id) + count(name) + count(category) + count(price) + count(availability) FROM products_dim
UNION ALL SELECT 'dim_campaigns', count(*),
  count(campaign_id) + count(name) + count(channel) + count(budget) + count(start_date) FROM campaigns_dim
UNION ALL SELECT 'fact_sales_transactions', count(*),
  count(transaction_id) + count(customer_id) + count(product_id) + count(amount) + count(transaction_date) FROM fact""")

cte("q2", ["filled"], f"""
SELECT table_name, n AS total_records, {half_up('cells', '5 * n', 2, 100)} AS overall_completeness_pct,
  'COMPLETENESS_CHECK' AS check_type,
  CASE WHEN overall_completeness_pct >= 95 THEN 'PASS' WHEN overall_completeness_pct >= 90 THEN 'WARNING'
       ELSE 'FAIL' END AS check_status,
  CASE check_status WHEN 'PASS' THEN 'Excellent data completeness' WHEN 'WARNING' THEN 'Acceptable with minor gaps'
       ELSE 'Critical completeness issues' END AS status_description
FROM filled""")

_FK = " UNION ALL ".join(
    f"""SELECT 'fact_transactions_to_{d}' AS relationship_name, count(*) AS total_records,
  count(*) FILTER (x.{k} IS NULL) AS orphaned_records FROM fact LEFT JOIN {c} x ON x.{k} = fact.{k}"""
    for d, c, k in (
        ("dim_customers", "customers_dim", "customer_id"),
        ("dim_products", "products_dim", "product_id"),
        ("dim_campaigns", "campaigns_dim", "campaign_id"),
    )
)
cte("q3", list(_ALL), f"""
SELECT *, {half_up('total_records - orphaned_records', 'total_records', 2, 100)} AS percentage,
  'FOREIGN_KEY_INTEGRITY' AS check_type,
  CASE WHEN percentage = 100 THEN 'PASS' WHEN percentage >= 95 THEN 'WARNING' ELSE 'FAIL' END AS check_status,
  CASE check_status WHEN 'PASS' THEN 'All foreign keys valid' WHEN 'WARNING' THEN 'Minor integrity violations detected'
       ELSE 'Critical integrity violations' END AS status_description
FROM ({_FK})""")
_USE = " UNION ALL ".join(
    f"""SELECT '{d}_orphaned' AS relationship_name, count(*) AS total_records,
  count(*) FILTER (fact.{k} IS NULL) AS orphaned_records FROM {c} x LEFT JOIN fact ON x.{k} = fact.{k}"""
    for d, c, k in (
        ("dim_customers", "customers_dim", "customer_id"),
        ("dim_products", "products_dim", "product_id"),
        ("dim_campaigns", "campaigns_dim", "campaign_id"),
    )
)
cte("q4", list(_ALL), f"""
SELECT *, {half_up('total_records - orphaned_records', 'total_records', 2, 100)} AS percentage,
  'DIMENSION_UTILIZATION' AS check_type,
  CASE WHEN orphaned_records = 0 THEN 'OPTIMAL' WHEN percentage >= 50 THEN 'GOOD' WHEN percentage >= 25 THEN 'WARNING'
       ELSE 'POOR' END AS check_status,
  CASE check_status WHEN 'OPTIMAL' THEN 'All dimensions fully utilized' WHEN 'GOOD' THEN 'Good dimension utilization'
       WHEN 'WARNING' THEN 'Some unused dimension records' ELSE 'Poor dimension utilization' END AS status_description
FROM ({_USE})""")

cte("spans", list(_ALL), """
SELECT 'dim_customers' AS table_name, count(*) AS n, max(registration_date)::TIMESTAMP AS hi,
  min(registration_date)::TIMESTAMP AS lo FROM customers_dim
UNION ALL SELECT 'dim_products', count(*), TIMESTAMP '2001-11-05 06:00:00', TIMESTAMP '2001-11-05 06:00:00'
  FROM products_dim
UNION ALL SELECT 'dim_campaigns', count(*), max(start_date)::TIMESTAMP, min(start_date)::TIMESTAMP FROM campaigns_dim
UNION ALL SELECT 'fact_sales_transactions', count(*), max(transaction_date)::TIMESTAMP,
  min(transaction_date)::TIMESTAMP FROM fact""")
cte("q6", ["spans"], f"""
SELECT table_name, n AS total_records, hi AS latest_data_timestamp, date_sub('hour', hi, {NOW}) AS hours_since_latest,
  date_sub('day', lo, hi) AS data_age_span_days, 'FRESHNESS_CHECK' AS check_type,
  CASE WHEN hours_since_latest <= 24 THEN 'FRESH' WHEN hours_since_latest <= 48 THEN 'ACCEPTABLE'
       WHEN hours_since_latest <= 168 THEN 'AGING' ELSE 'STALE' END AS freshness_status,
  CASE freshness_status WHEN 'FRESH' THEN 'Data is fresh (< 24 hours)'
       WHEN 'ACCEPTABLE' THEN 'Data is acceptable (< 48 hours)' WHEN 'AGING' THEN 'Data is aging (< 1 week)'
       ELSE 'Data is stale (> 1 week)' END AS status_description
FROM spans""")

cte("q7", ["filled"], f"""
SELECT table_name, n AS actual_count, lo AS min_expected, hi AS max_expected,
  {half_up('n', 'hi', 2, 100)} AS volume_percentage, 'VOLUME_CHECK' AS check_type,
  CASE WHEN n = 0 THEN 'CRITICAL' WHEN n < lo THEN 'LOW' WHEN n > hi THEN 'HIGH' ELSE 'NORMAL' END AS volume_status,
  CASE volume_status WHEN 'CRITICAL' THEN 'No data found - critical issue' WHEN 'LOW' THEN 'Volume below expected minimum'
       WHEN 'HIGH' THEN 'Volume exceeds expected maximum' ELSE 'Volume within expected range' END AS status_description,
  CASE volume_status WHEN 'CRITICAL' THEN 'Check data ingestion pipeline'
       WHEN 'LOW' THEN 'Investigate potential data loss' WHEN 'HIGH' THEN 'Check for data duplication'
       ELSE 'No action required' END AS recommended_action
FROM filled JOIN (VALUES ('dim_customers', 8000, 12000), ('dim_products', 5, 1000), ('dim_campaigns', 5, 2000),
  ('fact_sales_transactions', 1000, 100000)) e(table_name, lo, hi) USING (table_name)""")

cte("q8", ["q1", "q2", "q3", "q4", "q6", "q7"], f"""
SELECT table_name, check_type, check_status, {NOW} AS check_timestamp, violation_count::DOUBLE AS metric_value,
  0::DOUBLE AS threshold_value, NULL::VARCHAR AS status_description, NULL::VARCHAR AS recommended_action FROM q1
UNION ALL SELECT table_name, check_type, check_status, {NOW}, overall_completeness_pct, 95, status_description, NULL FROM q2
UNION ALL SELECT relationship_name, check_type, check_status, {NOW}, percentage, 100, status_description, NULL FROM q3
UNION ALL SELECT relationship_name, check_type, check_status, {NOW}, percentage, 50, status_description, NULL FROM q4
UNION ALL SELECT table_name, check_type, freshness_status, {NOW}, hours_since_latest, 24, status_description, NULL FROM q6
UNION ALL SELECT table_name, check_type, volume_status, {NOW}, actual_count, max_expected, status_description,
  recommended_action FROM q7""")

_COUNTS = """SELECT 'dim_customers' AS table_name, count(*) AS record_count FROM customers_dim
UNION ALL SELECT 'dim_products', count(*) FROM products_dim
UNION ALL SELECT 'dim_campaigns', count(*) FROM campaigns_dim
UNION ALL SELECT 'fact_sales_transactions', count(*) FROM fact"""


def _fk_share(table: str, key: str) -> str:
    return f"""SELECT '{key}' AS foreign_key, count(*) AS total_transactions, count(x.{key}) AS valid_refs,
  {half_up(f'count(x.{key})', 'count(*)', 2, 100)} AS integrity_pct
FROM fact LEFT JOIN {table} x ON fact.{key} = x.{key}"""


_NO = "fact.campaign_id = 'NO_CAMPAIGN'"
_VALID = f"count(*) FILTER (x.campaign_id IS NOT NULL OR {_NO})"


def _share(condition: str) -> str:
    return half_up(f"count(*) FILTER ({condition})", "count(*)", 2, 100)


ORACLES = {
    "q1_uniqueness": sql("SELECT * FROM (" + _unique("raw_key_counts") + ")", "raw_key_counts"),
    "q1_uniqueness_clean": sql(
        "SELECT * FROM (" + _unique("key_counts", "t <> 'dim_customers_email'") + ")", "key_counts"
    ),
    "q1_uniqueness_warehouse": sql("SELECT * FROM q1", "q1"),
    "q2_completeness": sql("SELECT * FROM q2", "q2"),
    "q3_fk_integrity": sql("SELECT * FROM q3", "q3"),
    "q4_dim_utilisation": sql("SELECT * FROM q4", "q4"),
    "q4_dim_utilisation_per_dimension": sql(
        "SELECT relationship_name, total_records, orphaned_records, percentage FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{d}_orphaned' AS relationship_name, count(*) AS total_records,
  count(*) FILTER (NOT used) AS orphaned_records, {half_up('count(*) FILTER (used)', 'count(*)', 2, 100)} AS percentage
FROM (SELECT {k} IN (SELECT {k} FROM fact) AS used FROM {c})"""
            for d, c, k in (
                ("dim_customers", "customers_dim", "customer_id"),
                ("dim_products", "products_dim", "product_id"),
                ("dim_campaigns", "campaigns_dim", "campaign_id"),
            )
        )
        + ")",
        *_ALL,
    ),
    "q5_integrity_report": sql("SELECT * FROM q3 UNION ALL BY NAME SELECT * FROM q4", "q3", "q4"),
    "q6_freshness": sql("SELECT * FROM q6", "q6"),
    "q7_volume": sql("SELECT * FROM q7", "q7"),
    "q8_results": sql("SELECT * FROM q8", "q8"),
    "q9_health": sql(
        f"""SELECT check_type, check_status, count(*) AS check_count,
  (SELECT if(bool_or(check_status IN ('FAIL', 'CRITICAL')), 'UNHEALTHY', 'HEALTHY') FROM q8
   WHERE check_timestamp::DATE = {AS_OF}) AS system_health
FROM q8 WHERE check_timestamp::DATE = {AS_OF} GROUP BY 1, 2""",
        "q8",
    ),
    "m1_latest": sql("SELECT * FROM q8 ORDER BY check_timestamp DESC, check_type, table_name LIMIT 20", "q8"),
    "m4_patterns": sql(
        """SELECT check_type, check_status, count(*) AS frequency,
  sum(metric_value::DECIMAL(28,6))::DOUBLE / count(metric_value) AS avg_score, min(metric_value) AS min_score
FROM q8 GROUP BY 1, 2""",
        "q8",
    ),
    "v2_counts": sql(_COUNTS, *_ALL),
    "v4_v5_fk": sql(
        _fk_share("customers_dim", "customer_id") + " UNION ALL " + _fk_share("products_dim", "product_id"), *_ALL
    ),
    "v6_campaign_fk": sql(
        f"""SELECT count(*) AS total_transactions, {_VALID} AS valid_campaign_refs,
  {half_up(_VALID, 'count(*)', 2, 100)} AS campaign_integrity_pct, count(*) FILTER ({_NO}) AS no_campaign_count
FROM fact LEFT JOIN campaigns_dim x ON x.campaign_id = fact.campaign_id""",
        "campaigns_dim", "fact",
    ),
    "v7_orphans": sql(
        """SELECT 'orphaned_customers' AS issue, count(*) AS count FROM fact ANTI JOIN customers_dim USING (customer_id)
UNION ALL SELECT 'orphaned_products', count(*) FROM fact ANTI JOIN products_dim USING (product_id)
UNION ALL SELECT 'orphaned_campaigns', count(*) FROM fact ANTI JOIN campaigns_dim USING (campaign_id)
  WHERE campaign_id <> 'NO_CAMPAIGN'""",
        *_ALL,
    ),
    "v8_keys": sql(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS table_name, count(*) AS total_records, count(DISTINCT {key}) AS unique_ids,
  if(count(*) = count(DISTINCT {key}), 'PASS', 'FAIL') AS uniqueness_check FROM {table}"""
            for name, table, key in (
                ("dim_customers", "customers_dim", "customer_id"),
                ("dim_products", "products_dim", "product_id"),
                ("dim_campaigns", "campaigns_dim", "campaign_id"),
                ("fact_sales_transactions", "fact", "transaction_id"),
            )
        ),
        *_ALL,
    ),
    "v9_completeness": sql(
        f"""SELECT 'dim_customers' AS table_name, {_share("first_name <> ''")} AS first_name_completeness,
  {_share("email <> ''")} AS email_completeness, {_share("country <> ''")} AS country_completeness
FROM customers_dim
UNION ALL SELECT 'dim_products', {_share("name <> ''")}, {_share("category <> ''")}, {_share("price > 0")}
FROM products_dim""",
        "customers_dim", "products_dim",
    ),
    "v10_nulls": sql(
        """SELECT 'fact_transactions_nulls' AS check_type, count(*) - count(customer_id) AS null_customer_ids,
  count(*) - count(product_id) AS null_product_ids,
  count(*) FILTER (amount IS NULL OR amount <= 0) AS null_or_zero_amounts,
  count(*) - count(transaction_date) AS null_transaction_dates FROM fact""",
        "fact",
    ),
    "v11_dates": sql(
        f"""SELECT 'date_validation' AS check_type, min(transaction_date) AS earliest_transaction,
  max(transaction_date) AS latest_transaction,
  count(*) FILTER (transaction_date < DATE '1998-01-01') AS dates_before_2020,
  count(*) FILTER (transaction_date > {AS_OF}) AS future_dates FROM fact""",
        "fact",
    ),
    "v12_country": sql(
        f"""SELECT country, count(*) AS transaction_count, sum(amount)::DOUBLE AS total_revenue,
  {mean('sum(amount)', 'count(*)')} AS avg_transaction_value
FROM fact JOIN customers_dim USING (customer_id) GROUP BY country ORDER BY sum(amount) DESC, country LIMIT 10""",
        "customers_dim", "fact",
    ),
    "v13_multi": sql(
        f"""SELECT category, country, m.channel AS channel, count(*) AS transaction_count,
  sum(amount)::DOUBLE AS total_revenue, {mean('sum(amount)', 'count(*)')} AS avg_transaction_value
FROM fact f JOIN customers_dim USING (customer_id) JOIN products_dim USING (product_id)
LEFT JOIN campaigns_dim m ON m.campaign_id = f.campaign_id
WHERE transaction_date >= DATE '1998-01-01'
GROUP BY category, country, m.channel HAVING count(*) > 10
ORDER BY sum(amount) DESC, category, country, ifnull(m.channel, 'DIRECT') LIMIT 20""",
        *_ALL,
    ),
    "v14_monthly": sql(
        """SELECT date_trunc('month', transaction_date)::DATE AS month, count(*) AS transaction_count,
  sum(amount)::DOUBLE AS monthly_revenue, count(DISTINCT customer_id) AS unique_customers
FROM fact WHERE transaction_date >= DATE '1998-01-01' GROUP BY 1""",
        "fact",
    ),
    "v15_summary": sql(
        f"""SELECT 'VALIDATION_SUMMARY' AS report_type, {NOW} AS validation_timestamp,
  (SELECT count(*) FROM customers_dim) AS customer_count, (SELECT count(*) FROM products_dim) AS product_count,
  (SELECT count(*) FROM campaigns_dim) AS campaign_count, (SELECT count(*) FROM fact) AS transaction_count,
  (SELECT sum(amount)::DOUBLE FROM fact) AS total_revenue""",
        *_ALL,
    ),
    "v16_country_kpi": sql(
        f"""SELECT country, count(DISTINCT customer_id) AS customers, sum(amount)::DOUBLE AS total_revenue,
  {mean('sum(amount)', 'count(*)')} AS avg_order_value
FROM fact JOIN customers_dim USING (customer_id) GROUP BY country ORDER BY sum(amount) DESC, country LIMIT 10""",
        "customers_dim", "fact",
    ),
    "v17_category": sql(
        """SELECT category, sum(amount)::DOUBLE AS revenue, count(transaction_id) AS transactions
FROM fact JOIN products_dim USING (product_id) GROUP BY category""",
        "products_dim", "fact",
    ),
    "g2_g4_gates": sql(
        """SELECT 'customers' AS table_name, count(*) AS record_count FROM stg_customers
UNION ALL SELECT 'products', count(*) FROM stg_products
UNION ALL SELECT 'marketing_campaigns', count(*) FROM stg_campaigns
UNION ALL SELECT 'sales_transactions', count(*) FROM stg_sales UNION ALL """ + _COUNTS,
        "stg_customers", "stg_products", "stg_campaigns", "stg_sales", *_ALL,
    ),
}
