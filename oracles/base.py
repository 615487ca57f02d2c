"""Shared pieces of the oracle SQL: staging feeds and star schema as CTEs.

Statements are composed from named CTEs; `sql(body, *names)` prepends the ones
a statement needs, with everything they build on, in order.

Fixed values: defaults and word lists of the cleaning rules.
"""

from __future__ import annotations

AS_OF = "DATE '2001-11-05'"


def half_up(num: str, den: str, digits: int, times: int = 1) -> str:
    """`times * num / den` rounded half away from zero, in exact integers.

    Both arguments are integer expressions in the same unit. Null when the
    denominator is zero or null.
    """
    k = times * 10**digits
    return (
        f"(CASE WHEN ({den}) <> 0 THEN sign({num})::HUGEINT * sign({den})::HUGEINT"
        f" * ((2 * abs(({num})::HUGEINT) * {k} + abs(({den})::HUGEINT)) // (2 * abs(({den})::HUGEINT)))"
        f" END)::DOUBLE / {10**digits}"
    )


def cents(value: str) -> str:
    return f"(({value}) * 100)::HUGEINT"


def mean(total: str, count: str) -> str:
    return f"({total})::DOUBLE / nullif({count}, 0)::DOUBLE"


SPACE = r"""E' \t\n\x0b\f\r'"""

# title case for words separated by single blanks; other separators do not occur
def title(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({text}), ' '),"
        " lambda w: upper(w[1]) || w[2:]), ' ')"
    )


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: list[str], body: str) -> None:
    CTES[name] = (needs, body)


def sql(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    if not order:
        return body
    parts = ",\n".join(f"{name} AS (\n{CTES[name][1]}\n)" for name in order)
    return f"WITH {parts}\n{body}"


cte("stg_customers", [], """
WITH feed AS (
  SELECT c_custkey,
    c_custkey::VARCHAR AS customer_id,
    CASE WHEN c_custkey % 40 <> 3 THEN lower(c_mktsegment) END AS first_name,
    '  ' || r_name || ' ' AS last_name,
    CASE WHEN c_acctbal < 0 THEN NULL
         WHEN c_custkey % 50 = 7 THEN 'customer-at-mail-' || c_custkey
         WHEN c_custkey % 97 = 5 THEN 'shared@mail.example.com'
         ELSE 'Customer' || c_custkey || '@Mail.example.com' END AS email,
    CASE WHEN c_custkey % 33 = 2 THEN NULL
         WHEN c_custkey % 10 = 0 THEN '12345'
         ELSE ' +39 (02) 55.x' || lpad(c_custkey::VARCHAR, 9, '0') END AS phone,
    CASE WHEN c_custkey % 21 <> 4 THEN ' Street ' || c_custkey END AS address,
    lower(r_name) AS city,
    ' ' || lower(n_name) AS country,
    CASE WHEN c_custkey % 60 <> 11 THEN DATE '1995-01-01' + (c_custkey % 1500)::INT END AS registration_date,
    c_custkey % 130 AS age
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)
SELECT * EXCLUDE (c_custkey) FROM feed
UNION ALL
SELECT * EXCLUDE (c_custkey) REPLACE (NULL AS email, DATE '2001-11-05' AS registration_date)
FROM feed WHERE c_custkey % 25 = 4
UNION ALL
SELECT * EXCLUDE (c_custkey) REPLACE ('no address' AS email, DATE '2001-11-05' AS registration_date)
FROM feed WHERE c_custkey % 75 = 9""")

cte("stg_products", [], """
WITH feed AS (
  SELECT p_partkey,
    p_partkey::VARCHAR AS product_id,
    CASE WHEN p_partkey % 45 <> 8 THEN p_name || ' ' END AS name,
    lower(p_type) AS category,
    CASE WHEN p_partkey % 4 <> 0 THEN lower(p_name) END AS subcategory,
    lower(p_brand) AS brand,
    CASE WHEN p_partkey % 70 = 9 THEN 0 ELSE p_retailprice::DECIMAL(18,2) END::DECIMAL(18,2) AS price,
    CASE WHEN p_partkey % 11 <> 0
         THEN CASE p_size % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'GBP' ELSE 'EUR' END END AS currency,
    CASE WHEN p_partkey % 19 <> 0 THEN ' About ' || p_name END AS description,
    CASE WHEN p_partkey % 13 <> 0 THEN p_size % 2 = 0 END AS availability,
    (p_size - 5)::BIGINT AS stock_quantity,
    p_size / 8.0::DOUBLE AS rating,
    p_partkey % 200 - 10 AS reviews_count,
    CASE WHEN p_partkey % 17 <> 0 THEN p_size / 16.0::DOUBLE END AS weight_kg,
    'nation ' || (p_partkey % 25) AS country_origin
  FROM part
)
SELECT * EXCLUDE (p_partkey) FROM feed
UNION ALL
SELECT * EXCLUDE (p_partkey) REPLACE (NULL AS price, TRUE AS availability) FROM feed WHERE p_partkey % 30 = 1""")

cte("stg_campaigns", [], """
WITH feed AS (
  SELECT s_suppkey,
    s_suppkey::VARCHAR AS campaign_id,
    CASE WHEN s_suppkey % 29 <> 3 THEN ' Campaign ' || s_suppkey END AS name,
    lower(r_name) AS channel,
    CASE s_suppkey % 5 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'PAUSED' WHEN 2 THEN 'COMPLETED'
                       WHEN 3 THEN 'active' END AS status,
    CASE WHEN s_suppkey % 6 <> 0 THEN ' everyone ' END AS target_audience,
    s_acctbal::DECIMAL(18,2) AS budget,
    round(s_acctbal::DECIMAL(18,2) * (s_suppkey % 13)::DECIMAL(2,0) * 0.1::DECIMAL(2,1), 2)::DECIMAL(18,2)
      AS actual_spend,
    (s_suppkey % 12) / 10.0::DOUBLE AS conversion_rate,
    s_suppkey * 100 - 500 AS impressions,
    s_suppkey % 7 * 10 AS clicks,
    s_suppkey % 9 AS conversions,
    CASE WHEN s_suppkey % 23 <> 0 THEN DATE '1995-01-01' + (s_suppkey * 17 % 2000)::INT END AS start_date,
    CASE WHEN s_suppkey % 8 = 0 THEN NULL
         WHEN s_suppkey % 14 = 3 THEN DATE '2099-12-31'
         ELSE DATE '1995-01-01' + (s_suppkey * 17 % 2000)::INT + (s_suppkey % 90 - 10)::INT END AS end_date,
    DATE '1995-01-01' + (s_suppkey * 17 % 2000)::INT AS created_date
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)
SELECT * EXCLUDE (s_suppkey) FROM feed
UNION ALL
SELECT * EXCLUDE (s_suppkey) REPLACE ('PAUSED' AS status, DATE '2001-11-05' AS start_date)
FROM feed WHERE s_suppkey % 10 = 5""")

cte("stg_sales", [], """
WITH priced AS (
  SELECT *, l_quantity::BIGINT AS units,
    (((2 * (l_extendedprice::DECIMAL(18,2) * 100)::BIGINT + l_quantity::BIGINT) // (2 * l_quantity::BIGINT))
      * 0.01)::DECIMAL(18,2) AS each
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), grossed AS (
  SELECT *, (units * each)::DECIMAL(18,2) AS gross FROM priced
), parts AS (
  SELECT *, round(gross * l_discount::DECIMAL(4,2), 2)::DECIMAL(18,2) AS disc,
    round(gross * l_tax::DECIMAL(4,2), 2)::DECIMAL(18,2) AS tax FROM grossed
)
SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
  CASE WHEN l_orderkey % 83 = 0 THEN 'nobody' ELSE o_custkey::VARCHAR END AS customer_id,
  CASE WHEN l_orderkey % 89 = 0 THEN 'nothing' ELSE l_partkey::VARCHAR END AS product_id,
  CASE l_returnflag WHEN 'R' THEN '' WHEN 'A' THEN l_suppkey::VARCHAR END AS campaign_id,
  CASE WHEN l_orderkey % 101 = 0 THEN 0 ELSE units END AS quantity,
  each AS unit_price,
  CASE WHEN l_orderkey % 59 = 0 THEN 0
       ELSE gross - disc + tax + CASE WHEN l_orderkey % 37 = 0 THEN 0.02
                                      WHEN l_orderkey % 41 = 0 THEN 0.01 ELSE 0 END END::DECIMAL(18,2) AS amount,
  CASE WHEN l_discount <> 0 THEN disc END AS discount_amount,
  tax AS tax_amount,
  CASE WHEN l_orderkey % 211 <> 0 THEN l_shipdate END AS transaction_date,
  CASE o_orderstatus WHEN 'F' THEN CASE WHEN l_returnflag = 'A' THEN 'COMPLETED' ELSE 'completed' END
                     WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status,
  CASE l_linenumber WHEN 1 THEN 'credit_card' WHEN 2 THEN ' PayPal ' WHEN 3 THEN 'cash' WHEN 4 THEN 'voucher'
                    WHEN 5 THEN NULL ELSE 'bank_transfer' END AS payment_method,
  CASE WHEN l_partkey % 9 <> 0 THEN ' Dock ' || l_suppkey END AS shipping_address,
  CASE WHEN l_partkey % 5 <> 0 THEN 'ring twice ' END AS order_notes,
  o_orderdate AS created_date,
  l_shipdate AS updated_date
FROM parts""")

cte("customers_dim", ["stg_customers"], f"""
WITH ranked AS (
  SELECT * FROM stg_customers WHERE customer_id IS NOT NULL
  QUALIFY 1 = row_number() OVER (
    PARTITION BY customer_id
    ORDER BY (email IS NULL)::INT, (phone IS NULL)::INT, registration_date DESC NULLS LAST,
      first_name NULLS LAST, last_name NULLS LAST, email NULLS LAST, phone NULLS LAST, address NULLS LAST,
      city NULLS LAST, country NULLS LAST, age NULLS LAST)
)
SELECT customer_id,
  ifnull(trim({title('first_name')}), 'Unknown') AS first_name,
  ifnull(trim({title('last_name')}), 'Unknown') AS last_name,
  trim(lower(email)) AS email,
  ifnull(regexp_replace(trim(phone), '[^0-9+() -]', '', 'g'), 'Not Provided') AS phone,
  ifnull(trim(address), 'Not Provided') AS address,
  ifnull(trim({title('city')}), 'Not Provided') AS city,
  ifnull(trim(upper(country)), 'UNKNOWN') AS country,
  if(age >= 0 AND age <= 120, age, 30) AS age,
  ifnull(registration_date::DATE, DATE '1900-01-01') AS registration_date,
  TRUE AS email_valid,
  ifnull(length(trim(phone)) > 9, FALSE) AS phone_valid
FROM ranked
WHERE regexp_full_match(email, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}')""")

cte("products_dim", ["stg_products"], f"""
WITH ranked AS (
  SELECT *, ifnull(price > 0, FALSE) AS priced FROM stg_products WHERE product_id IS NOT NULL
  QUALIFY 1 = row_number() OVER (
    PARTITION BY product_id
    ORDER BY (name IS NULL)::INT, (NOT priced)::INT, (NOT ifnull(availability, FALSE))::INT,
      name NULLS LAST, category NULLS LAST, subcategory NULLS LAST, brand NULLS LAST, price NULLS LAST,
      currency NULLS LAST, description NULLS LAST, availability NULLS LAST, stock_quantity NULLS LAST,
      rating NULLS LAST, reviews_count NULLS LAST, weight_kg NULLS LAST, country_origin NULLS LAST)
)
SELECT product_id,
  ifnull(trim(name), 'Unknown Product') AS name,
  ifnull(trim(upper(category)), 'UNCATEGORIZED') AS category,
  ifnull(trim(upper(subcategory)), 'GENERAL') AS subcategory,
  ifnull(trim({title('brand')}), 'Generic') AS brand,
  CASE WHEN NOT priced THEN 0
       WHEN currency IN ('USD', 'GBP')
       THEN (((price * 100)::BIGINT * if(currency = 'USD', 85, 115) + 50) // 100) * 0.01
       ELSE price END::DECIMAL(18,2) AS price,
  'EUR' AS currency,
  ifnull(trim(description), 'No description available') AS description,
  ifnull(availability, FALSE) AS availability,
  greatest(ifnull(stock_quantity, 0), 0) AS stock_quantity,
  if(rating >= 0 AND rating <= 5, floor(rating * 100 + 0.5) / 100, 0) AS rating,
  greatest(ifnull(reviews_count, 0), 0) AS reviews_count,
  CASE WHEN weight_kg > 0 THEN floor(weight_kg * 1000 + 0.5) / 1000 END AS weight_kg,
  ifnull(trim(upper(country_origin)), 'UNKNOWN') AS country_origin,
  ifnull(trim(name) <> '', FALSE) AS name_valid,
  ifnull(trim(category) <> '', FALSE) AS category_valid,
  priced AS price_valid
FROM ranked""")

cte("campaigns_dim", ["stg_campaigns"], f"""
WITH ranked AS (
  SELECT * FROM stg_campaigns WHERE campaign_id IS NOT NULL
  QUALIFY 1 = row_number() OVER (
    PARTITION BY campaign_id
    ORDER BY (name IS NULL)::INT, if(status IN ('ACTIVE', 'COMPLETED'), 0, 1), start_date DESC NULLS LAST,
      name NULLS LAST, channel NULLS LAST, status NULLS LAST, target_audience NULLS LAST, budget NULLS LAST,
      actual_spend NULLS LAST, conversion_rate NULLS LAST, impressions NULLS LAST, clicks NULLS LAST,
      conversions NULLS LAST, start_date NULLS LAST, end_date NULLS LAST)
)
SELECT campaign_id,
  ifnull(trim(name), 'Unknown Campaign') AS name,
  ifnull(trim(upper(channel)), 'UNKNOWN') AS channel,
  ifnull(trim(upper(status)), 'DRAFT') AS status,
  ifnull(trim(target_audience), 'General Audience') AS target_audience,
  greatest(ifnull(budget, 0), 0)::DECIMAL(18,2) AS budget,
  greatest(ifnull(actual_spend, 0), 0)::DECIMAL(18,2) AS actual_spend,
  CASE WHEN conversion_rate <= 1 THEN floor(conversion_rate * 10000 + 0.5) / 10000 END AS conversion_rate,
  greatest(impressions, 0) AS impressions,
  greatest(clicks, 0) AS clicks,
  greatest(conversions, 0) AS conversions,
  ifnull(start_date, DATE '1900-01-01') AS start_date,
  if(end_date IS NULL, DATE '2099-12-31', greatest(end_date, ifnull(start_date, end_date))) AS end_date,
  ifnull(trim(name) <> '', FALSE) AS name_valid,
  ifnull(trim(channel) <> '', FALSE) AS channel_valid,
  ifnull(status IN ('ACTIVE', 'PAUSED', 'COMPLETED', 'DRAFT'), TRUE) AS status_valid,
  ifnull(actual_spend > budget AND budget > 0, FALSE) AS over_budget,
  CASE WHEN budget > 0 THEN {half_up(cents('actual_spend'), cents('budget'), 2, 100)} END AS spend_percentage,
  CASE WHEN clicks > 0 THEN {half_up('conversions', 'clicks', 4, 100)} END AS calculated_conversion_rate,
  if(end_date = DATE '2099-12-31', {AS_OF}, end_date) - start_date AS campaign_duration_days
FROM ranked""")

cte("best_sales", ["stg_sales"], """
SELECT * FROM stg_sales WHERE transaction_id IS NOT NULL
QUALIFY 1 = row_number() OVER (
  PARTITION BY transaction_id
  ORDER BY if(status = 'COMPLETED', 0, 1), transaction_date DESC NULLS LAST,
    customer_id NULLS LAST, product_id NULLS LAST, campaign_id NULLS LAST, quantity NULLS LAST,
    unit_price NULLS LAST, amount NULLS LAST, discount_amount NULLS LAST, tax_amount NULLS LAST,
    status NULLS LAST, payment_method NULLS LAST, shipping_address NULLS LAST, order_notes NULLS LAST,
    created_date NULLS LAST, updated_date NULLS LAST)""")

cte("fact", ["best_sales", "customers_dim", "products_dim"], f"""
WITH tidy AS (
  SELECT transaction_id, customer_id, product_id, ifnull(campaign_id, 'NO_CAMPAIGN') AS campaign_id,
    if(quantity > 0, quantity, 1) AS quantity,
    greatest(ifnull(unit_price, 0), 0)::DECIMAL(18,2) AS unit_price,
    greatest(ifnull(amount, 0), 0)::DECIMAL(18,2) AS amount,
    greatest(ifnull(discount_amount, 0), 0)::DECIMAL(18,2) AS discount_amount,
    greatest(ifnull(tax_amount, 0), 0)::DECIMAL(18,2) AS tax_amount,
    ifnull(transaction_date::DATE, DATE '1900-01-01') AS transaction_date,
    trim(upper(ifnull(payment_method, 'UNKNOWN'))) AS payment_method,
    trim(upper(ifnull(status, 'PENDING'))) AS status,
    trim(ifnull(shipping_address, 'Not Provided')) AS shipping_address,
    trim(ifnull(order_notes, '')) AS order_notes
  FROM best_sales
  SEMI JOIN customers_dim USING (customer_id)
  SEMI JOIN products_dim USING (product_id)
), measured AS (
  SELECT *, (quantity * unit_price)::DECIMAL(18,2) AS gross,
    (quantity * unit_price - discount_amount + tax_amount)::DECIMAL(18,2) AS total FROM tidy
)
SELECT * EXCLUDE (gross, total), gross AS calculated_gross_amount, total AS calculated_total_amount,
  {half_up(cents('discount_amount'), cents('gross'), 2, 100)} AS discount_percentage,
  {half_up(cents('tax_amount'), cents('amount - tax_amount'), 2, 100)} AS tax_rate,
  abs(amount - total) <= 0.01 AS amount_calculation_valid,
  status IN ('PENDING', 'COMPLETED', 'CANCELLED', 'REFUNDED') AS status_valid,
  payment_method IN ('CREDIT_CARD', 'DEBIT_CARD', 'PAYPAL', 'BANK_TRANSFER', 'CASH', 'UNKNOWN')
    AS payment_method_valid
FROM measured
WHERE status IN ('COMPLETED', 'PENDING') AND amount > 0""")
