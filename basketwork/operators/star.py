"""Staging feeds to the star schema: three dimensions and one fact.

Every flag, rank and ratio reads the raw feed column, never the cleaned column
of the same name: a padded email is invalid even though its trimmed form would
pass. So each transform ranks the raw rows first and then derives all output
columns in one `select` from raw columns.

Ranks end with every remaining feed column, so that a re-run keeps the same row
when the business order ties.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketwork import schemas
from basketwork.functions.numbers import MONEY, PRICE, RATE, money, non_negative, percent
from basketwork.functions.text import clean_phone, is_blank, is_email, title_case, trim_all
from basketwork.operators.joins import attach, column_bytes, first_per_key

# Defaults, limits and word lists of the cleaning rules.
MAX_AGE = 120
DEFAULT_AGE = 30
MIN_PHONE_LENGTH = 10
FIRST_DATE = dt.date(1900, 1, 1)
LAST_DATE = dt.date(2099, 12, 31)
TARGET_CURRENCY = "EUR"
EUR_RATES = {"USD": "0.85", "GBP": "1.15"}
CAMPAIGN_STATUSES = ["ACTIVE", "PAUSED", "COMPLETED", "DRAFT"]
PREFERRED_CAMPAIGN_STATUSES = ["ACTIVE", "COMPLETED"]
SALE_STATUSES = ["PENDING", "COMPLETED", "CANCELLED", "REFUNDED"]
KEPT_SALE_STATUSES = ["COMPLETED", "PENDING"]
PREFERRED_SALE_STATUS = "COMPLETED"
PAYMENT_METHODS = ["CREDIT_CARD", "DEBIT_CARD", "PAYPAL", "BANK_TRANSFER", "CASH", "UNKNOWN"]
NO_CAMPAIGN = "NO_CAMPAIGN"
AMOUNT_TOLERANCE = "0.01"


def _or(value: Column, default: object) -> Column:
    return F.coalesce(value, F.lit(default))


def _when_first(condition: Column) -> Column:
    """Sort key that puts rows meeting the condition first; null does not meet it."""
    return _or(condition, False).desc()


def _ties(feed: str, used: Sequence[str]) -> list[Column]:
    names = [f.name for f in schemas.FEEDS[feed].fields if f.name not in used]
    return [F.col(name).asc_nulls_last() for name in names]


def _loaded(loaded_at: Column | None) -> Column:
    return F.current_timestamp() if loaded_at is None else loaded_at


def dim_customers(customers: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """One row per customer with a valid email.

    The best record of a customer is chosen before the email test: if it fails,
    the customer is dropped even when a lower-ranked record would pass.
    """
    c = F.col
    best = first_per_key(
        customers.filter(c("customer_id").isNotNull()),
        "customer_id",
        [
            c("email").isNotNull().desc(),
            c("phone").isNotNull().desc(),
            c("registration_date").desc_nulls_last(),
            *_ties("customers", ["customer_id", "registration_date"]),
        ],
    )
    loaded = _loaded(loaded_at)
    return best.filter(is_email(c("email"))).select(
        "customer_id",
        _or(trim_all(title_case(c("first_name"))), "Unknown").alias("first_name"),
        _or(trim_all(title_case(c("last_name"))), "Unknown").alias("last_name"),
        trim_all(F.lower("email")).alias("email"),
        _or(clean_phone(c("phone")), "Not Provided").alias("phone"),
        _or(trim_all(c("address")), "Not Provided").alias("address"),
        _or(trim_all(title_case(c("city"))), "Not Provided").alias("city"),
        _or(trim_all(F.upper("country")), "UNKNOWN").alias("country"),
        _or(F.when(c("age").between(0, MAX_AGE), c("age")), DEFAULT_AGE).cast("bigint").alias("age"),
        _or(F.to_date("registration_date"), FIRST_DATE).alias("registration_date"),
        loaded.alias("created_date"),
        loaded.alias("last_updated_date"),
        F.lit(True).alias("email_valid"),
        _or(F.length(trim_all(c("phone"))) >= MIN_PHONE_LENGTH, False).alias("phone_valid"),
    )


def dim_products(
    products: DataFrame,
    loaded_at: Column | None = None,
    rates: dict[str, str] | None = None,
) -> DataFrame:
    """One row per product, priced in EUR.

    `rates` maps a currency to its EUR rate; converted prices are rounded to
    cents, prices in any other currency pass unchanged.
    """
    c = F.col
    priced = _or(c("price") > 0, False)
    best = first_per_key(
        products.filter(c("product_id").isNotNull()),
        "product_id",
        [
            c("name").isNotNull().desc(),
            priced.desc(),
            _when_first(c("availability")),
            *_ties("products", ["product_id"]),
        ],
    )
    amount = c("price").cast(PRICE)
    in_eur = amount
    for currency, rate in (EUR_RATES if rates is None else rates).items():
        converted = F.round(amount * F.lit(rate).cast(RATE), 2).cast(PRICE)
        in_eur = F.when(c("currency") == currency, converted).otherwise(in_eur)
    rating = F.when(c("rating").between(0, 5), F.round(c("rating").cast(RATE), 2))
    loaded = _loaded(loaded_at)
    return best.select(
        "product_id",
        _or(trim_all(c("name")), "Unknown Product").alias("name"),
        _or(trim_all(F.upper("category")), "UNCATEGORIZED").alias("category"),
        _or(trim_all(F.upper("subcategory")), "GENERAL").alias("subcategory"),
        _or(trim_all(title_case(c("brand"))), "Generic").alias("brand"),
        F.when(priced, in_eur).otherwise(F.lit(0).cast(PRICE)).alias("price"),
        F.lit(TARGET_CURRENCY).alias("currency"),
        _or(trim_all(c("description")), "No description available").alias("description"),
        _or(c("availability"), False).alias("availability"),
        non_negative(c("stock_quantity")).alias("stock_quantity"),
        _or(rating.cast("double"), 0.0).alias("rating"),
        non_negative(c("reviews_count")).alias("reviews_count"),
        F.when(c("weight_kg") > 0, F.round(c("weight_kg").cast(RATE), 3).cast("double")).alias("weight_kg"),
        _or(trim_all(F.upper("country_origin")), "UNKNOWN").alias("country_origin"),
        loaded.alias("created_date"),
        loaded.alias("last_updated_date"),
        (~is_blank(c("name"))).alias("name_valid"),
        (~is_blank(c("category"))).alias("category_valid"),
        priced.alias("price_valid"),
    )


def dim_campaigns(
    campaigns: DataFrame,
    as_of: dt.date | None = None,
    loaded_at: Column | None = None,
) -> DataFrame:
    """One row per campaign with clamped figures, ratios and duration.

    A campaign whose raw end is the open end date runs until `as_of` (today).
    """
    c = F.col
    today = F.current_date() if as_of is None else F.lit(as_of)
    start, end = F.to_date("start_date"), F.to_date("end_date")
    best = first_per_key(
        campaigns.filter(c("campaign_id").isNotNull()),
        "campaign_id",
        [
            c("name").isNotNull().desc(),
            _when_first(c("status").isin(PREFERRED_CAMPAIGN_STATUSES)),
            start.desc_nulls_last(),
            *_ties("marketing_campaigns", ["campaign_id"]),
        ],
    )
    budget, spend = c("budget").cast(PRICE), c("actual_spend").cast(PRICE)
    clicks, conversions = c("clicks"), c("conversions")
    rate = F.when(c("conversion_rate").between(0, 1), F.round(c("conversion_rate").cast(RATE), 4))
    ran_until = F.when(end == F.lit(LAST_DATE), today).otherwise(end)
    loaded = _loaded(loaded_at)
    return best.select(
        "campaign_id",
        _or(trim_all(c("name")), "Unknown Campaign").alias("name"),
        _or(trim_all(F.upper("channel")), "UNKNOWN").alias("channel"),
        _or(trim_all(F.upper("status")), "DRAFT").alias("status"),
        _or(trim_all(c("target_audience")), "General Audience").alias("target_audience"),
        money(c("budget")).alias("budget"),
        money(c("actual_spend")).alias("actual_spend"),
        rate.cast("double").alias("conversion_rate"),
        non_negative(c("impressions")).alias("impressions"),
        non_negative(clicks).alias("clicks"),
        non_negative(conversions).alias("conversions"),
        _or(start, FIRST_DATE).alias("start_date"),
        # greatest() skips a null start, as a comparison with it would
        _or(F.when(end.isNotNull(), F.greatest(end, start)), LAST_DATE).alias("end_date"),
        loaded.alias("created_date"),
        loaded.alias("last_updated_date"),
        (~is_blank(c("name"))).alias("name_valid"),
        (~is_blank(c("channel"))).alias("channel_valid"),
        _or(c("status").isin(CAMPAIGN_STATUSES), True).alias("status_valid"),
        _or((spend > budget) & (budget > 0), False).alias("over_budget"),
        F.when(budget > 0, percent(spend, budget, 2, kind=PRICE)).alias("spend_percentage"),
        F.when(clicks > 0, percent(conversions, clicks, 4)).alias("calculated_conversion_rate"),
        F.datediff(ran_until, start).cast("bigint").alias("campaign_duration_days"),
    )


def best_transactions(
    transactions: DataFrame, columns: Sequence[str] | None = None, within: Sequence[str] = ()
) -> DataFrame:
    """One raw row per transaction id: completed first, then the newest.

    The status is compared as delivered, so `completed` in lower case gains no
    preference. `columns` are the wanted ones, by default all. Ties are broken in the order of the feed's columns, so
    those behind the last wanted column cannot change a wanted value: they are left out before the shuffle. `within`:
    see `first_per_key`.
    """
    c = F.col
    ties = _ties("sales_transactions", ["transaction_id"])
    if columns is not None:
        names = schemas.TRANSACTIONS.fieldNames()
        used = names[: max(names.index(name) for name in columns) + 1]
        ties = _ties("sales_transactions", ["transaction_id", *names[len(used) :]])
        used += [name for name in ("transaction_date", "status") if name not in used]
        transactions = transactions.select(*within, *used)
    return first_per_key(
        transactions.filter(c("transaction_id").isNotNull()),
        "transaction_id",
        [
            _when_first(c("status") == PREFERRED_SALE_STATUS),
            c("transaction_date").desc_nulls_last(),
            *ties,
        ],
        within,
    ).drop(*within)


def fk_flags(
    transactions: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    campaigns: DataFrame,
    sizes: Callable[[DataFrame], int] | None = None,
    columns: Sequence[str] | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Best transactions with `customer_exists`, `product_exists`, `campaign_exists`.

    A transaction without campaign (null or empty) counts as existing. `columns`, `within`: see `best_transactions`.
    """
    best = best_transactions(transactions, columns, within)
    for dim, key, flag in (
        (customers, "customer_id", "customer_exists"),
        (products, "product_id", "product_exists"),
        (campaigns, "campaign_id", "campaign_exists"),
    ):
        keys = dim.select(key).distinct().withColumn(flag, F.lit(True))
        size = _size(dim.select(key), sizes)
        best = attach(best, keys, key, "left", size, salt_on="transaction_id", counted=transactions)
        best = best.withColumn(flag, _or(F.col(flag), False))
    no_campaign = _or(F.col("campaign_id") == "", True)
    return best.withColumn("campaign_exists", no_campaign | F.col("campaign_exists"))


def _size(df: DataFrame, sizes: Callable[[DataFrame], int] | None) -> int:
    return sum(column_bytes(df).values()) if sizes is None else sizes(df)


# The columns of the feed that the fact is made of.
FACT_SOURCES = [
    "transaction_id", "customer_id", "product_id", "campaign_id", "quantity", "unit_price", "amount", "discount_amount", "tax_amount",
    "transaction_date", "payment_method", "status", "shipping_address", "order_notes",
]


def clean_sales(best: DataFrame, loaded_at: Column | None = None, empty_campaign_as_null: bool = False) -> DataFrame:
    """Cleaned measures, derived amounts and flags of deduplicated transactions."""
    return with_derived(cleaned_sales(best, loaded_at, empty_campaign_as_null))


def cleaned_sales(best: DataFrame, loaded_at: Column | None = None, empty_campaign_as_null: bool = False) -> DataFrame:
    """Cleaned measures of deduplicated transactions."""
    c = F.col
    campaign = F.nullif(c("campaign_id"), F.lit("")) if empty_campaign_as_null else c("campaign_id")
    return best.select(
        "transaction_id",
        "customer_id",
        "product_id",
        _or(campaign, NO_CAMPAIGN).alias("campaign_id"),
        F.when(c("quantity") > 0, c("quantity")).otherwise(F.lit(1)).cast("bigint").alias("quantity"),
        *[money(c(name)).alias(name) for name in ("unit_price", "amount", "discount_amount", "tax_amount")],
        _or(F.to_date("transaction_date"), FIRST_DATE).alias("transaction_date"),
        trim_all(F.upper(_or(c("payment_method"), "UNKNOWN"))).alias("payment_method"),
        trim_all(F.upper(_or(c("status"), "PENDING"))).alias("status"),
        trim_all(_or(c("shipping_address"), "Not Provided")).alias("shipping_address"),
        trim_all(_or(c("order_notes"), "")).alias("order_notes"),
        _loaded(loaded_at).alias("created_timestamp"),
    )


def with_derived(cleaned: DataFrame) -> DataFrame:
    """`cleaned_sales` with derived amounts and flags; they need no other row, so they are best added after a shuffle."""
    c = F.col
    gross = (c("quantity") * c("unit_price")).cast(MONEY)
    total = (gross - c("discount_amount") + c("tax_amount")).cast(MONEY)
    return cleaned.select(
        "*",
        gross.alias("calculated_gross_amount"),
        total.alias("calculated_total_amount"),
        percent(c("discount_amount"), gross).alias("discount_percentage"),
        percent(c("tax_amount"), c("amount") - c("tax_amount")).alias("tax_rate"),
        (F.abs(c("amount") - total) <= F.lit(AMOUNT_TOLERANCE).cast(MONEY)).alias("amount_calculation_valid"),
        c("status").isin(SALE_STATUSES).alias("status_valid"),
        c("payment_method").isin(PAYMENT_METHODS).alias("payment_method_valid"),
    )


def without_derived(sales: DataFrame) -> DataFrame:
    """The columns of `cleaned_sales` of a fact, from which `with_derived` makes the others again."""
    return sales.select(*FACT_SOURCES, "created_timestamp")


def fact_sales(
    transactions: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    loaded_at: Column | None = None,
    empty_campaign_as_null: bool = False,
    sizes: Callable[[DataFrame], int] | None = None,
) -> DataFrame:
    """Completed and pending sales with a known customer and product.

    The campaign need not exist. An empty campaign id stays empty unless
    `empty_campaign_as_null` is set.
    """
    return with_derived(kept_sales(transactions, customers, products, loaded_at, empty_campaign_as_null, sizes))


def kept_sales(
    transactions: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    loaded_at: Column | None = None,
    empty_campaign_as_null: bool = False,
    sizes: Callable[[DataFrame], int] | None = None,
    within: Sequence[str] = (),
    counted: DataFrame | None = None,
) -> DataFrame:
    """`fact_sales` without the derived columns; `within`: see `best_transactions`.

    Hot keys are counted in `counted`, by default in `transactions`.
    """
    sales = cleaned_sales(best_transactions(transactions, FACT_SOURCES, within), loaded_at, empty_campaign_as_null)
    kept = sales.filter(F.col("status").isin(KEPT_SALE_STATUSES) & (F.col("amount") > 0))
    for dim, key in ((customers, "customer_id"), (products, "product_id")):
        keys = dim.select(key)
        kept = attach(
            kept, keys, key, "left_semi", _size(keys, sizes), salt_on="transaction_id", counted=transactions if counted is None else counted
        )
    return kept.select(*sales.columns)
