"""Oracle SQL of the star-schema tables (money shown as double)."""

from oracles.base import sql

_CUSTOMERS = sql("SELECT * FROM customers_dim", "customers_dim")
_PRODUCTS = sql("SELECT * REPLACE (price::DOUBLE AS price) FROM products_dim", "products_dim")
_CAMPAIGNS = sql(
    "SELECT * REPLACE (budget::DOUBLE AS budget, actual_spend::DOUBLE AS actual_spend) FROM campaigns_dim",
    "campaigns_dim",
)
_FACT = sql(
    """SELECT * REPLACE (unit_price::DOUBLE AS unit_price, amount::DOUBLE AS amount,
  discount_amount::DOUBLE AS discount_amount, tax_amount::DOUBLE AS tax_amount,
  calculated_gross_amount::DOUBLE AS calculated_gross_amount,
  calculated_total_amount::DOUBLE AS calculated_total_amount) FROM fact""",
    "fact",
)
_FLAGS = sql(
    """SELECT transaction_id,
  EXISTS (FROM customers_dim d WHERE d.customer_id = s.customer_id) AS customer_exists,
  EXISTS (FROM products_dim d WHERE d.product_id = s.product_id) AS product_exists,
  ifnull(campaign_id, '') = '' OR EXISTS (FROM campaigns_dim d WHERE d.campaign_id = s.campaign_id)
    AS campaign_exists
FROM best_sales s""",
    "best_sales", "customers_dim", "products_dim", "campaigns_dim",
)

ORACLES = {
    "t1_dim_customers": _CUSTOMERS,
    "t2_dim_products": _PRODUCTS,
    "t3_dim_campaigns": _CAMPAIGNS,
    "t4_fact_sales": _FACT,
    "t4_fk_flags": _FLAGS,
    "d11_streamed_fact": _FACT,
}
