"""Oracle SQL of the documented rules and key figures."""

from oracles.base import cents, half_up, sql
from oracles.checks import _ALL
import oracles.lineage  # noqa: F401  (defines the run log)

_S = "stg_customers", "stg_products", "stg_campaigns", "stg_sales"


def _filled(table: str, name: str, limit: int, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{c}' AS column_name, {half_up(f'count({c})', 'count(*)', 2, 100)} AS completeness_pct,
  {limit}::DOUBLE AS limit_pct, if(100 * count({c}) >= {limit} * count(*) AND count(*) > 0, 'PASS', 'FAIL') AS status FROM {table}"""
        for c in columns
    )


ORACLES = {
    "d1_campaign_window": sql(
        """SELECT transaction_id, campaign_id, transaction_date, start_date, end_date
FROM fact JOIN campaigns_dim USING (campaign_id)
WHERE transaction_date < start_date OR transaction_date > end_date""",
        "fact", "campaigns_dim",
    ),
    "d2_rules": sql(
        """SELECT 'positive_quantity' AS rule, count(*) AS checked, count(*) FILTER (quantity <= 0) AS violations FROM stg_sales
UNION ALL SELECT 'positive_unit_price', count(*), count(*) FILTER (unit_price <= 0) FROM stg_sales
UNION ALL SELECT 'discount_within_gross', count(*), count(*) FILTER (discount_amount > quantity * unit_price) FROM stg_sales
UNION ALL SELECT 'end_not_before_start', count(*), count(*) FILTER (end_date < start_date) FROM stg_campaigns""",
        "stg_sales", "stg_campaigns",
    ),
    "d3_campaign_kpis": sql(
        f"""SELECT c.campaign_id, ifnull(revenue, 0)::DOUBLE AS revenue,
  {half_up(cents('ifnull(revenue, 0)'), cents('actual_spend'), 4)} AS roas,
  {half_up(cents('actual_spend'), '100 * conversions', 4)} AS cost_per_acquisition,
  {half_up('conversions', 'clicks', 4, 100)} AS conversion_rate
FROM campaigns_dim c LEFT JOIN (SELECT campaign_id, sum(amount) AS revenue FROM fact GROUP BY 1) r
  ON r.campaign_id = c.campaign_id""",
        "fact", "campaigns_dim",
    ),
    "d3_business_kpis": sql(
        f"""SELECT
  {half_up('(SELECT count(*) FROM (SELECT 1 FROM fact GROUP BY customer_id HAVING count(*) > 1))', '(SELECT count(*) FROM customers_dim)', 2, 100)} AS retention_rate,
  {half_up(cents('(SELECT sum(actual_spend) FROM campaigns_dim)'), '100 * (SELECT count(DISTINCT customer_id) FROM fact)', 2)} AS customer_acquisition_cost,
  {half_up('(SELECT sum(quantity) FROM fact)', '(SELECT sum(stock_quantity) FROM products_dim)', 4)} AS inventory_turnover""",
        *_ALL,
    ),
    "d4_daily_volumes": sql(
        """SELECT transaction_date AS day, 'sales' AS metric, count(*) AS n,
  CASE WHEN count(*) < 50 THEN 'LOW' WHEN count(*) > 500 THEN 'HIGH' ELSE 'NORMAL' END AS status
FROM fact GROUP BY 1
UNION ALL SELECT registration_date, 'new_customers', count(*),
  CASE WHEN count(*) < 10 THEN 'LOW' WHEN count(*) > 100 THEN 'HIGH' ELSE 'NORMAL' END
FROM customers_dim GROUP BY 1""",
        "fact", "customers_dim",
    ),
    "d4_concurrent_campaigns": sql(
        """SELECT day, active_campaigns,
  CASE WHEN active_campaigns < 1 THEN 'LOW' WHEN active_campaigns > 20 THEN 'HIGH' ELSE 'NORMAL' END AS status
FROM (
  SELECT day, (SELECT count(*) FROM campaigns_dim WHERE day BETWEEN start_date AND end_date) AS active_campaigns
  FROM (SELECT start_date AS day FROM campaigns_dim UNION SELECT end_date + 1 FROM campaigns_dim)
)""",
        "campaigns_dim",
    ),
    "d4_catalogue_change": sql(
        f"""SELECT count(*) AS product_count, {half_up('count(*) - 1900', '1900', 2, 100)} AS change_pct,
  if(abs({half_up('count(*) - 1900', '1900', 2, 100)}) <= 10, 'NORMAL', 'ANOMALY') AS status FROM products_dim""",
        "products_dim",
    ),
    "d5_completeness_limits": sql(
        " UNION ALL ".join(
            [
                _filled("customers_dim", "dim_customers", 95, ["email", "country", "registration_date"]),
                _filled("products_dim", "dim_products", 98, ["name", "category", "price"]),
                _filled("campaigns_dim", "dim_campaigns", 90, ["name", "channel", "start_date", "end_date"]),
                _filled("fact", "fact_sales_transactions", 99, ["customer_id", "product_id", "amount"]),
            ]
        ),
        *_ALL,
    ),
    "d6_health_score": sql(
        """SELECT *, (quality_score + performance_score + availability_score) / 3 AS health_score,
  CASE WHEN health_score >= 95 THEN 'PRODUCTION_READY' WHEN health_score >= 90 THEN 'WARNING' ELSE 'CRITICAL' END AS health_level
FROM (
  SELECT (SELECT sum(s)::DOUBLE / count(*) FROM (
      SELECT CASE WHEN check_type <> 'UNIQUENESS_CHECK' THEN metric_value WHEN check_status = 'PASS' THEN 100 ELSE 0
        END::DECIMAL(18,6) AS s
      FROM q8 WHERE check_type IN ('COMPLETENESS_CHECK', 'FOREIGN_KEY_INTEGRITY', 'UNIQUENESS_CHECK'))) AS quality_score,
    100 * (count(*) FILTER (execution_duration_seconds <= 300)::DOUBLE / count(*)) AS performance_score,
    100 * (count(*) FILTER (execution_status <> 'FAILED')::DOUBLE / count(*)) AS availability_score
  FROM runs WHERE execution_status <> 'RUNNING'
)""",
        "q8", "runs",
    ),
    "d7_severity": sql(
        """SELECT table_name, check_type, check_status, metric_value,
  CASE WHEN check_type = 'VOLUME_CHECK' AND check_status = 'CRITICAL' THEN 'P0'
       WHEN check_type = 'UNIQUENESS_CHECK' AND check_status = 'FAIL' THEN 'P1'
       WHEN check_type = 'FOREIGN_KEY_INTEGRITY' AND metric_value < 95 THEN 'P1'
       WHEN check_type = 'COMPLETENESS_CHECK' AND metric_value < 90 THEN 'P1'
       WHEN check_type = 'COMPLETENESS_CHECK' AND metric_value < 95 THEN 'P2'
       WHEN check_type = 'FRESHNESS_CHECK' AND check_status IN ('AGING', 'STALE') THEN 'P2' ELSE 'P3' END AS severity
FROM q8""",
        "q8",
    ),
    "d8_slow_steps": sql(
        """SELECT * FROM (
  SELECT execution_id, dag_id, task_id, s AS execution_duration_seconds, b AS baseline_seconds,
    CASE WHEN s > 5 * b THEN 'CRITICAL' WHEN s * 100 > 120 * b THEN 'DEGRADED' END AS alert
  FROM (
    SELECT *, execution_duration_seconds AS s,
      sum(execution_duration_seconds) OVER step::DOUBLE / count(*) OVER step AS b
    FROM runs WHERE execution_status <> 'RUNNING' WINDOW step AS (PARTITION BY dag_id, task_id)
  )
) WHERE alert IS NOT NULL""",
        "runs",
    ),
    "d9_quarantine": sql(
        """SELECT transaction_id, reasons FROM (
  SELECT transaction_id, concat_ws(',', if(amount_calculation_valid, NULL, 'amount_differs'),
    if(payment_method_valid, NULL, 'unknown_payment_method'), if(status_valid, NULL, 'unknown_status'),
    if(transaction_date = DATE '1900-01-01', 'date_missing', NULL)) AS reasons
  FROM fact
) WHERE reasons <> ''""",
        "fact",
    ),
    "d10_daily_sales": sql(
        """SELECT transaction_date, payment_method, count(*) AS transactions, sum(amount)::DOUBLE AS revenue,
  sum(quantity)::BIGINT AS units FROM fact GROUP BY 1, 2""",
        "fact",
    ),
    "d12_expected_records": sql(
        f"""SELECT feed, a AS actual_records, e AS expected_records, {half_up('a', 'e', 2, 100)} AS delivered_pct FROM (
  SELECT ifnull(feed, 'total') AS feed, sum(a)::BIGINT AS a, sum(e)::BIGINT AS e FROM (
    SELECT 'customers' AS feed, count(*) AS a, 10000 AS e FROM stg_customers
    UNION ALL SELECT 'products', count(*), 500 FROM stg_products
    UNION ALL SELECT 'marketing_campaigns', count(*), 1000 FROM stg_campaigns
    UNION ALL SELECT 'sales_transactions', count(*), 50000 FROM stg_sales
  ) GROUP BY ROLLUP (feed)
)""",
        *_S,
    ),
}
