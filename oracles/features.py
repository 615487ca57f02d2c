"""Oracle SQL of baselines, snapshots, views, kept aggregates, documents and deliveries.

Fixed values: columns of the warehouse tables.
"""

from oracles.base import half_up, sql
from oracles.lineage import ORACLES as LINEAGE

_ALL = ("customers_dim", "products_dim", "campaigns_dim", "fact")

_CUSTOMERS = (
    "customer_id string, first_name string, last_name string, email string, phone string, address string, city string, "
    "country string, age bigint, registration_date date, created_date timestamp, last_updated_date timestamp, "
    "email_valid boolean, phone_valid boolean"
)
_PRODUCTS = (
    "product_id string, name string, category string, subcategory string, brand string, price decimal(18,6), "
    "currency string, description string, availability boolean, stock_quantity bigint, rating double, "
    "reviews_count bigint, weight_kg double, country_origin string, created_date timestamp, "
    "last_updated_date timestamp, name_valid boolean, category_valid boolean, price_valid boolean"
)
_CAMPAIGNS = (
    "campaign_id string, name string, channel string, status string, target_audience string, budget decimal(18,2), "
    "actual_spend decimal(18,2), conversion_rate double, impressions bigint, clicks bigint, conversions bigint, "
    "start_date date, end_date date, created_date timestamp, last_updated_date timestamp, name_valid boolean, "
    "channel_valid boolean, status_valid boolean, over_budget boolean, spend_percentage double, "
    "calculated_conversion_rate double, campaign_duration_days bigint"
)
_SALES = (
    "transaction_id string, customer_id string, product_id string, campaign_id string, quantity bigint, "
    "unit_price decimal(18,2), amount decimal(18,2), discount_amount decimal(18,2), tax_amount decimal(18,2), "
    "transaction_date date, payment_method string, status string, shipping_address string, order_notes string, "
    "created_timestamp timestamp, calculated_gross_amount decimal(18,2), calculated_total_amount decimal(18,2), "
    "discount_percentage double, tax_rate double, amount_calculation_valid boolean, status_valid boolean, "
    "payment_method_valid boolean"
)


def _columns(table: str, text: str) -> str:
    rows = [c.split(" ") for c in text.split(", ")]
    return ", ".join(f"('{table}', {i}, '{name}', '{kind}')" for i, (name, kind) in enumerate(rows, 1))


_BEFORE = "(PARTITION BY table_name ORDER BY day RANGE BETWEEN INTERVAL 28 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING)"
_STATISTICS = f"""
SELECT table_name, day, n AS actual_count, history_days, m AS median_count, d AS mad,
  round(m - reach, 6) AS lower_bound, round(m + reach, 6) AS upper_bound,
  CASE WHEN history_days < 7 THEN 'NO_BASELINE' WHEN n = 0 THEN 'CRITICAL' WHEN n < m - reach THEN 'LOW'
       WHEN n > m + reach THEN 'HIGH' ELSE 'NORMAL' END AS volume_status
FROM (
  SELECT *, greatest(m * (20 / 100), d * (3.0::DOUBLE * 1.4826::DOUBLE)) AS reach FROM (
    SELECT table_name, day, n, count(*) OVER w AS history_days, median(n::DOUBLE) OVER w AS m, mad(n::DOUBLE) OVER w AS d
    FROM (
      SELECT table_name, day, coalesce(n, 0)::BIGINT AS n
      FROM (SELECT table_name, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM counted GROUP BY 1)
      LEFT JOIN counted USING (table_name, day)
    )
    WINDOW w AS {_BEFORE}
  )
)"""

_COUNTED = """counted AS (
  SELECT 'fact_sales_transactions' AS table_name, transaction_date AS day, count(*) AS n FROM fact
  WHERE transaction_date >= DATE '1995-01-01' GROUP BY 2
  UNION ALL SELECT 'dim_customers', registration_date, count(*) FROM customers_dim
  WHERE registration_date >= DATE '1995-01-01' GROUP BY 2
)"""

_SLOW = """SELECT execution_id, step, day, s AS execution_duration_seconds, b AS baseline_seconds, n AS baseline_runs,
  if(s > 5 * b, 'CRITICAL', 'DEGRADED') AS alert
FROM timed JOIN (
  SELECT step, day, n, min(s) AS b FROM (
    SELECT d.step, d.day, t.s, row_number() OVER (PARTITION BY d.step, d.day ORDER BY t.s) AS place,
      count(*) OVER (PARTITION BY d.step, d.day) AS n
    FROM (SELECT DISTINCT step, day FROM timed) d
    JOIN timed t ON t.step = d.step AND t.day BETWEEN d.day - 14 AND d.day - 1
  ) WHERE 2 * place >= n GROUP BY ALL
) USING (step, day)
WHERE s * 100 > 120 * b"""
_TIMED = """timed AS (
  SELECT execution_id, dag_id || '/' || task_id AS step, start_time::DATE AS day, execution_duration_seconds AS s
  FROM runs WHERE execution_status <> 'RUNNING'
)"""


def _with(more: str, body: str, *names: str) -> str:
    """`sql` with one more common table expression before the body."""
    return sql(f"SELECT * FROM (WITH {more} {body})", *names)


_CHANGE = half_up("product_count - previous_count", "previous_count", 2, 100)
_SNAPSHOTS = f"""SELECT *, CASE WHEN snapshot_day IS NULL THEN 'NO_SNAPSHOT' WHEN abs(change_pct) <= 10 THEN 'NORMAL' ELSE 'ANOMALY' END AS status
FROM (
  SELECT day, product_count, snapshot_day, previous_count, {_CHANGE} AS change_pct
  FROM known ASOF LEFT JOIN (
    SELECT max(day) AS snapshot_day, arg_max(product_count, day) AS previous_count FROM known GROUP BY date_trunc('month', day)
  ) ON day > snapshot_day
)"""
_KNOWN = """known AS (
  SELECT day, sum(count(*)) OVER (ORDER BY day)::BIGINT AS product_count
  FROM (SELECT product_id, min(transaction_date) AS day FROM fact GROUP BY 1) GROUP BY day
)"""

_REACH = """
WITH RECURSIVE edge AS (SELECT DISTINCT source_id, target_id FROM captures), entry AS (
  SELECT source_id AS id, source_name AS name FROM sources UNION ALL SELECT target_id, target_name FROM targets
), walk AS (
  SELECT source_id, target_id, 1 AS depth FROM edge
  UNION ALL SELECT w.source_id, e.target_id, depth + 1 FROM walk w JOIN edge e ON w.target_id = e.source_id WHERE depth < 20
)
SELECT a.name AS source_name, b.name AS target_name, min(depth) AS depth
FROM walk JOIN entry a ON a.id = source_id JOIN entry b ON b.id = target_id GROUP BY ALL"""

ORACLES = {
    "q7_volume_statistical": _with(_COUNTED, _STATISTICS, "fact", "customers_dim"),
    "d8_moving_baseline": _with(_TIMED, _SLOW, "runs"),
    "d4_catalogue_snapshots": _with(_KNOWN, _SNAPSHOTS, "fact"),
    "l7_reach": sql(f"SELECT * FROM ({_REACH})", "captures", "sources", "targets"),
    "s21_view_complete_lineage": LINEAGE["l7_complete"],
    "s21_view_field_lineage": LINEAGE["l8_field"],
    "s21_view_quality_impact": LINEAGE["l9_impact"],
    "s21_view_dependencies": LINEAGE["l10_dependencies"],
    "s21_bucketed_customers": sql(
        """SELECT customer_id, country, coalesce(n, 0) AS transactions, coalesce(r, 0)::DOUBLE AS revenue
FROM customers_dim LEFT JOIN (SELECT customer_id, count(*) AS n, sum(amount) AS r FROM fact GROUP BY 1) USING (customer_id)""",
        "fact", "customers_dim",
    ),
    "g1_g5_existence": sql(
        """SELECT 'dim_customers' AS table_name, TRUE AS table_exists, count(*) AS record_count FROM customers_dim
UNION ALL SELECT 'dim_products', TRUE, count(*) FROM products_dim
UNION ALL SELECT 'fact_sales_transactions', TRUE, count(*) FROM fact
UNION ALL SELECT 'dim_campaigns', FALSE, NULL""",
        "customers_dim", "products_dim", "fact",
    ),
    "d10_monthly_from_days": sql(
        """SELECT strftime(transaction_date, '%Y-%m') AS month, count(*) AS transactions, sum(amount)::DOUBLE AS revenue,
  sum(quantity)::BIGINT AS units, count(DISTINCT customer_id) AS buyers FROM fact GROUP BY 1""",
        "fact",
    ),
    "x13_flattened_events": "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events",
    "x13_flattened_campaigns": sql(
        """SELECT campaign_id, channel AS about_channel, budget::DOUBLE AS about_figures_money_planned,
  actual_spend::DOUBLE AS about_figures_money_spent, clicks || ',' || conversions AS about_figures_counts, status
FROM stg_campaigns WHERE start_date IS NOT NULL""",
        "stg_campaigns",
    ),
    "x13_flattened_campaign_steps": sql(
        """SELECT campaign_id, 0 AS position, 'start' AS name, strftime(start_date, '%Y-%m-%d') AS day
FROM stg_campaigns WHERE start_date IS NOT NULL
UNION ALL SELECT campaign_id, 1, 'end', strftime(end_date, '%Y-%m-%d') FROM stg_campaigns WHERE start_date IS NOT NULL""",
        "stg_campaigns",
    ),
    "x13_rescued_cells": """
SELECT 'age' AS column_name, count(*) AS cells FROM customer WHERE c_custkey % 31 < 2 AND c_custkey % 41 <> 0
UNION ALL SELECT 'registration_date', count(*) FROM customer WHERE c_custkey % 37 = 0 AND c_custkey % 41 <> 0
UNION ALL SELECT '(record)', count(*) FROM customer WHERE c_custkey % 41 = 0""",
    "x13_delivery_duplicates": sql(
        """SELECT * FROM (WITH first AS (SELECT * FROM stg_customers WHERE registration_date < DATE '2001-11-05'),
versions AS (SELECT DISTINCT * FROM stg_customers), known AS (SELECT DISTINCT * FROM first)
SELECT 1 AS delivery, 'new' AS status, count(DISTINCT customer_id) AS records FROM first
UNION ALL SELECT 1, 'changed', (SELECT count(*) FROM known) - count(DISTINCT customer_id) FROM first
UNION ALL SELECT 1, 'repeated', count(*) - (SELECT count(*) FROM known) FROM first
UNION ALL SELECT 2, 'new', count(DISTINCT customer_id) FROM versions WHERE customer_id NOT IN (SELECT customer_id FROM first)
UNION ALL SELECT 2, 'changed', (SELECT count(*) FROM versions) - (SELECT count(*) FROM known)
  - (SELECT count(DISTINCT customer_id) FROM versions WHERE customer_id NOT IN (SELECT customer_id FROM first))
UNION ALL SELECT 2, 'repeated', count(*) - (SELECT count(*) FROM versions) + (SELECT count(*) FROM known) FROM stg_customers
) WHERE records > 0""",
        "stg_customers",
    ),
    "s4_newest_capped": sql(
        """SELECT transaction_id, status, transaction_date::DATE AS day FROM stg_sales
WHERE status IN ('completed', 'pending', 'cancelled')
QUALIFY 200 >= row_number() OVER (PARTITION BY status ORDER BY transaction_date DESC NULLS LAST, transaction_id,
  customer_id NULLS LAST, product_id NULLS LAST, campaign_id NULLS LAST, quantity NULLS LAST, unit_price NULLS LAST)""",
        "stg_sales",
    ),
    "s7_enforced_contracts": sql(
        """SELECT 'customers' AS feed, 'raised' AS outcome, FALSE AS valid, count(*) AS record_count FROM stg_customers
UNION ALL SELECT 'products', 'raised', FALSE, count(*) FROM stg_products
UNION ALL SELECT 'marketing_campaigns', 'accepted', FALSE, count(*) FROM stg_campaigns
UNION ALL SELECT 'sales_transactions', 'accepted', TRUE, count(*) FROM stg_sales""",
        "stg_customers", "stg_products", "stg_campaigns", "stg_sales",
    ),
    "s8_metadata": sql(
        """SELECT TIMESTAMP '2001-11-05 12:00:00' AS loaded, 'drop of customers' AS origin, count(*) AS records FROM stg_customers
UNION ALL SELECT TIMESTAMP '2001-11-05 12:00:00', 'drop of products', count(*) FROM stg_products
UNION ALL SELECT TIMESTAMP '2001-11-05 12:00:00', 'drop of marketing_campaigns', count(*) FROM stg_campaigns
UNION ALL SELECT TIMESTAMP '2001-11-05 12:00:00', 'drop of sales_transactions', count(*) FROM stg_sales""",
        "stg_customers", "stg_products", "stg_campaigns", "stg_sales",
    ),
    "s17_created_if_absent": sql(
        """SELECT 'created' AS step, 0 AS records UNION ALL SELECT 'loaded', count(*) FROM stg_customers
UNION ALL SELECT 'kept', count(*) FROM stg_customers""",
        "stg_customers",
    ),
    "s14_layer_drops": """SELECT * FROM (VALUES ('synthetic_customers', 2, TRUE), ('products', 1, TRUE),
('marketing_campaigns', 1, TRUE), ('sales_transactions', 1, TRUE)) v(feed, drops, filled)""",
    "s23_freshness_limit": "SELECT * FROM (VALUES (0, TRUE, 0.0::DOUBLE), (24, TRUE, 24.0::DOUBLE), (25, FALSE, 25.0::DOUBLE)) v(hours_later, fresh, age_hours)",
    "v1_table_rows": sql(
        """SELECT 'dim_customers' AS table_name, count(*) AS row_count, TRUE AS has_bytes FROM customers_dim
UNION ALL SELECT 'dim_products', count(*), TRUE FROM products_dim
UNION ALL SELECT 'dim_campaigns', count(*), TRUE FROM campaigns_dim
UNION ALL SELECT 'fact_sales_transactions', count(*), TRUE FROM fact""",
        *_ALL,
    ),
    "v3_schema_columns": "SELECT * FROM (VALUES " + ", ".join(
        _columns(name, text) for name, text in (
            ("dim_customers", _CUSTOMERS), ("dim_products", _PRODUCTS), ("dim_campaigns", _CAMPAIGNS), ("fact_sales_transactions", _SALES),
        )
    ) + ") v(table_name, position, column_name, data_type)",
    "d11_streamed_transactions": sql(
        """SELECT count(DISTINCT transaction_id) AS records, count(DISTINCT transaction_id) AS transactions
FROM stg_sales WHERE status IN ('completed', 'pending', 'cancelled')""",
        "stg_sales",
    ),
}
