"""Oracle SQL of the eleven business reports.

Fixed values: output names, labels, limits, and the order of the rules in the CASE ladders.
"""

from oracles.base import AS_OF, cents, half_up, mean, sql

_C, _P, _M, _F = "customers_dim", "products_dim", "campaigns_dim", "fact"
_REV = cents("sum(amount)")

a1 = sql(f"""
SELECT customer_id, any_value(first_name) AS first_name, any_value(last_name) AS last_name,
  any_value(country) AS country, any_value(registration_date) AS registration_date,
  count(DISTINCT transaction_id) AS total_transactions,
  sum(amount)::DOUBLE AS total_revenue,
  {mean('sum(amount)', 'count(amount)')} AS avg_transaction_value,
  max(transaction_date) AS last_purchase_date,
  {AS_OF} - max(transaction_date) AS days_since_last_purchase,
  {half_up(_REV + ' * count(DISTINCT transaction_id)', f'100 * greatest({AS_OF} - max(transaction_date), 1)', 2)}
    AS clv_score
FROM customers_dim NATURAL JOIN fact
GROUP BY customer_id
HAVING sum(amount) > 1000
ORDER BY clv_score DESC, customer_id
LIMIT 20""", _C, _F)

_A2_BODY = f"""
SELECT customer_segment, age_group, country, count(*) AS customer_count,
  {mean('sum(spent)', 'count(*)')} AS avg_total_spent,
  {mean('sum(typical)', 'count(*)')} AS avg_order_value,
  {mean('sum(days)', 'count(*)')} AS avg_recency_days
FROM (
  SELECT country, spent, days, typical,
    CASE WHEN days <= 30 AND n >= 5 AND spent >= 2000 THEN 'Champions'
         WHEN days <= 60 AND n >= 3 AND spent >= 1000 THEN 'Loyal Customers'
         WHEN days <= 90 AND n >= 2 THEN 'Potential Loyalists'
         WHEN days <= 30 AND n < 3 THEN 'New Customers'
         WHEN days > 90 AND spent >= 1000 THEN 'At Risk'
         WHEN days > 180 THEN 'Cannot Lose Them' ELSE 'Others' END AS customer_segment,
    CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
         WHEN age < 55 THEN '45-54' ELSE '55+' END AS age_group
  FROM (
    SELECT customer_id, any_value(age) AS age, any_value(country) AS country, count(*) AS n,
      sum(amount) AS spent, ({mean('sum(amount)', 'count(*)')})::DECIMAL(28,6) AS typical,
      {AS_OF} - max(transaction_date) AS days
    FROM customers_dim NATURAL JOIN fact GROUP BY customer_id
  )
)
GROUP BY ALL"""
a2 = sql(_A2_BODY, _C, _F)

_ACTIVE = f"count(DISTINCT customer_id) FILTER (transaction_date >= {AS_OF} - 90)"
a3 = sql(f"""
SELECT country, count(DISTINCT customer_id) AS total_customers,
  count(DISTINCT transaction_id) AS total_transactions, sum(amount)::DOUBLE AS total_revenue,
  {mean('sum(amount)', 'count(*)')} AS avg_transaction_value,
  {mean('sum(amount)', 'count(DISTINCT customer_id)')} AS revenue_per_customer,
  {mean('count(DISTINCT transaction_id)', 'count(DISTINCT customer_id)')} AS transactions_per_customer,
  {_ACTIVE} AS active_customers_90d,
  {half_up(_ACTIVE, 'count(DISTINCT customer_id)', 2, 100)} AS active_customer_rate
FROM customers_dim NATURAL JOIN fact GROUP BY country""", _C, _F)

_SPEND = cents("ifnull(actual_spend, 0)")
a4 = sql(f"""
SELECT ifnull(name, 'No Campaign Attribution') AS campaign_name, ifnull(channel, 'DIRECT') AS channel,
  ifnull(budget, 0)::DOUBLE AS campaign_budget, ifnull(actual_spend, 0)::DOUBLE AS actual_spend,
  count(DISTINCT transaction_id) AS transactions, count(DISTINCT customer_id) AS unique_customers,
  sum(amount)::DOUBLE AS total_revenue, {mean('sum(amount)', 'count(*)')} AS avg_transaction_value,
  CASE WHEN actual_spend > 0 THEN {half_up(f'{_REV} - {_SPEND}', _SPEND, 2, 100)} END AS roi_percentage,
  {half_up(_SPEND, '100 * count(DISTINCT customer_id)', 2)} AS cost_per_acquisition,
  CASE WHEN roi_percentage IS NULL THEN 'Direct Sales' WHEN roi_percentage >= 200 THEN 'Excellent'
       WHEN roi_percentage >= 100 THEN 'Good' WHEN roi_percentage >= 50 THEN 'Average'
       WHEN roi_percentage >= 0 THEN 'Poor' ELSE 'Loss Making' END AS performance_rating
FROM fact LEFT JOIN campaigns_dim d ON fact.campaign_id = d.campaign_id
GROUP BY name, d.channel, d.budget, d.actual_spend""", _M, _F)

_DIVISOR = cents("sum(ifnull(actual_spend, 1))")
a5 = sql(f"""
SELECT ifnull(d.channel, 'DIRECT') AS channel, count(DISTINCT transaction_id) AS total_transactions,
  sum(amount)::DOUBLE AS total_revenue, count(DISTINCT customer_id) AS unique_customers,
  {mean('sum(amount)', 'count(*)')} AS avg_transaction_value,
  sum(ifnull(actual_spend, 0))::DOUBLE AS total_spend,
  {half_up(_REV, _DIVISOR, 2)} AS revenue_per_dollar_spent,
  {half_up('100 * count(DISTINCT transaction_id)', _DIVISOR, 4)} AS transactions_per_dollar_spent,
  {half_up(_REV, cents('(SELECT sum(amount) FROM fact)'), 2, 100)} AS revenue_share_pct
FROM fact LEFT JOIN campaigns_dim d USING (campaign_id)
GROUP BY d.channel""", _M, _F)

a6 = sql(f"""
SELECT category, brand, count(DISTINCT transaction_id) AS transaction_count,
  sum(quantity)::BIGINT AS total_quantity_sold, sum(amount)::DOUBLE AS total_revenue,
  {mean('sum(unit_price)', 'count(*)')} AS avg_selling_price, {mean('sum(price)', 'count(*)')} AS catalog_price,
  {half_up(cents('sum(unit_price)'), cents('sum(price)'), 2, 100)} AS price_realization_pct,
  {mean('sum(amount)', 'sum(quantity)')} AS revenue_per_unit, count(DISTINCT customer_id) AS unique_buyers,
  rank() OVER (ORDER BY sum(amount) DESC) AS revenue_rank,
  rank() OVER (ORDER BY sum(quantity) DESC) AS volume_rank
FROM products_dim NATURAL JOIN (
  SELECT product_id, transaction_id, customer_id, quantity, amount, unit_price FROM fact)
GROUP BY category, brand
HAVING count(DISTINCT transaction_id) >= 10
ORDER BY sum(amount) DESC, category, brand LIMIT 25""", _P, _F)

a7 = sql(f"""
SELECT product_id, any_value(name) AS name, any_value(category) AS category,
  any_value(stock_quantity) AS stock_quantity, any_value(price)::DOUBLE AS catalog_price,
  ifnull(sum(quantity), 0)::BIGINT AS total_sold, ifnull(sum(amount), 0)::DOUBLE AS total_revenue,
  {AS_OF} - max(transaction_date) AS days_since_last_sale,
  CASE WHEN sum(quantity) IS NULL THEN 'No Sales'
       WHEN days_since_last_sale <= 30 AND sum(quantity) >= 10 THEN 'Fast Moving'
       WHEN days_since_last_sale <= 60 AND sum(quantity) >= 5 THEN 'Regular Moving'
       WHEN days_since_last_sale <= 90 THEN 'Slow Moving' ELSE 'Dead Stock' END AS inventory_category,
  CASE WHEN any_value(stock_quantity) = 0 THEN 'Out of Stock' WHEN any_value(stock_quantity) <= 5 THEN 'Low Stock'
       WHEN any_value(stock_quantity) <= 20 THEN 'Normal Stock' ELSE 'Overstocked' END AS stock_status
FROM products_dim LEFT JOIN fact USING (product_id)
GROUP BY product_id
ORDER BY list_position(['Fast Moving', 'Regular Moving', 'Slow Moving', 'Dead Stock', 'No Sales'],
  inventory_category), total_revenue DESC, product_id
LIMIT 50""", _P, _F)

a8 = sql(f"""
SELECT month, n AS transactions, rev::DOUBLE AS revenue, buyers AS active_customers,
  {mean('rev', 'n')} AS avg_transaction_value,
  ifnull(growth, 0) AS mom_revenue_growth_pct, avg3 AS revenue_3month_avg,
  CASE WHEN growth >= 20 THEN 'High Growth' WHEN growth >= 5 THEN 'Moderate Growth'
       WHEN growth >= -5 THEN 'Stable' WHEN growth >= -20 THEN 'Moderate Decline'
       ELSE 'Significant Decline' END AS growth_category
FROM (
  SELECT *, {half_up(cents('rev - lag(rev) OVER m'), cents('lag(rev) OVER m'), 2, 100)} AS growth,
    {half_up(cents('sum(rev) OVER w'), '100 * count(*) OVER w', 2)} AS avg3
  FROM (
    SELECT date_trunc('month', transaction_date)::DATE AS month, count(DISTINCT transaction_id) AS n,
      sum(amount) AS rev, count(DISTINCT customer_id) AS buyers
    FROM fact GROUP BY 1
  )
  WINDOW m AS (ORDER BY month), w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
)""", _F)

a9 = sql(f"""
SELECT cohort_month, cohort_size, period_number, count(DISTINCT customer_id) AS active_customers,
  {half_up('count(DISTINCT customer_id)', 'cohort_size', 2, 100)} AS retention_rate
FROM (
  SELECT c.customer_id, cohort_month, cohort_size,
    date_diff('month', cohort_month, date_trunc('month', transaction_date)::DATE) AS period_number
  FROM (
    SELECT customer_id, date_trunc('month', registration_date)::DATE AS cohort_month,
      count(*) OVER (PARTITION BY date_trunc('month', registration_date)) AS cohort_size
    FROM customers_dim
  ) c JOIN fact USING (customer_id)
)
WHERE period_number <= 6
GROUP BY cohort_month, cohort_size, period_number""", _C, _F)

_LAST = f"FILTER (transaction_date >= {AS_OF} - 30)"
a10 = sql(f"""
SELECT 'Business Performance Summary' AS metric_category, count(DISTINCT transaction_id) AS total_transactions,
  sum(amount)::DOUBLE AS total_revenue, count(DISTINCT f.customer_id) AS total_customers,
  count(DISTINCT p.product_id) AS products_sold,
  count(DISTINCT m.campaign_id) FILTER (m.campaign_id <> 'NO_CAMPAIGN') AS active_campaigns,
  {half_up(_REV, '100 * count(*)', 2)} AS avg_transaction_value,
  {half_up(_REV, '100 * count(DISTINCT f.customer_id)', 2)} AS revenue_per_customer,
  count(DISTINCT transaction_id) {_LAST} AS transactions_last_30d,
  ifnull(sum(amount) {_LAST}, 0)::DOUBLE AS revenue_last_30d,
  {half_up(cents(f'sum(amount) {_LAST}'), f'100 * count(*) {_LAST}', 2)} AS avg_transaction_value_30d
FROM fact f JOIN customers_dim c USING (customer_id) JOIN products_dim p USING (product_id)
LEFT JOIN campaigns_dim m ON m.campaign_id = f.campaign_id""", _C, _P, _M, _F)

_SUMMED = cents("sum(ifnull(m.actual_spend, 0))")


def attribution(min_sales: int, limit: int) -> str:
    return sql(f"""
SELECT country, category, ifnull(m.channel, 'DIRECT') AS channel, count(DISTINCT transaction_id) AS transactions,
  sum(amount)::DOUBLE AS revenue, count(DISTINCT f.customer_id) AS unique_customers,
  {mean('sum(amount)', 'count(*)')} AS avg_transaction_value,
  sum(ifnull(m.actual_spend, 0))::DOUBLE AS marketing_spend,
  {half_up(_REV, '100 * count(DISTINCT f.customer_id)', 2)} AS revenue_per_customer,
  {half_up('count(DISTINCT transaction_id)', 'count(DISTINCT f.customer_id)', 2)} AS transactions_per_customer,
  CASE WHEN sum(m.actual_spend) > 0 THEN {half_up(f'{_REV} - {_SUMMED}', _SUMMED, 2, 100)} END AS roi_percentage
FROM fact f JOIN customers_dim c USING (customer_id) JOIN products_dim p USING (product_id)
LEFT JOIN campaigns_dim m ON m.campaign_id = f.campaign_id
GROUP BY country, category, m.channel
HAVING count(DISTINCT transaction_id) >= {min_sales}
ORDER BY sum(amount) DESC, country, category, 3 LIMIT {limit}""", _C, _P, _M, _F)


ORACLES = {
    "a1_clv": a1,
    "a2_segmentation": a2,
    "a3_geography": a3,
    "a4_campaign_roi": a4,
    "a5_channels": a5,
    "a6_products": a6,
    "a7_inventory": a7,
    "a8_seasonal": a8,
    "a9_cohorts": a9,
    "a10_executive": a10,
    "a11_attribution": attribution(5, 50),
}
