"""The eleven business reports over the star schema.

Sales are reduced before they meet a dimension wherever the report allows it:
per customer, product or month. A hot customer or product is then one row at
the join. Distinct customers of a group are counted by grouping twice (group and
customer, then group), which combines on the map side and needs no row
expansion. `as_of` stands for today in every report.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketwork.functions.numbers import count_if, first_match, mean, percent, ratio
from basketwork.operators.warehouse import Warehouse
from basketwork.session import checkpointed

# Limits of the reports, and labels of their classes.
MIN_CLV_REVENUE = 1000
TOP_CUSTOMERS = 20
ACTIVE_DAYS = 90
RECENT_DAYS = 30
MIN_PRODUCT_SALES = 10
TOP_PRODUCT_GROUPS = 25
TOP_INVENTORY = 50
COHORT_PERIODS = 6
MIN_ATTRIBUTED_SALES = 5
TOP_ATTRIBUTION = 50
UNATTRIBUTED = "No Campaign Attribution"
DIRECT = "DIRECT"
NULL_ROI_SORTS_AS = 999
AGE_BANDS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
OLDEST_BAND = "55+"
ROI_RATINGS = [(200, "Excellent"), (100, "Good"), (50, "Average"), (0, "Poor")]
NO_ROI_RATING, WORST_ROI_RATING = "Direct Sales", "Loss Making"
STOCK_LEVELS = [(5, "Low Stock"), (20, "Normal Stock")]
NO_STOCK, MUCH_STOCK = "Out of Stock", "Overstocked"
MOVEMENT_ORDER = ["Fast Moving", "Regular Moving", "Slow Moving", "Dead Stock", "No Sales"]
GROWTH_CLASSES = [(20, "High Growth"), (5, "Moderate Growth"), (-5, "Stable"), (-20, "Moderate Decline")]
WORST_GROWTH = "Significant Decline"
SUMMARY_TITLE = "Business Performance Summary"


def _n() -> Column:
    return F.count(F.lit(1))


def _revenue() -> Column:
    return F.sum("amount")


def _double(name: str, alias: str | None = None) -> Column:
    return F.col(name).cast("double").alias(alias or name)


def _days_since(as_of: dt.date, date: str) -> Column:
    return F.datediff(F.lit(as_of), F.col(date)).cast("bigint")


def _per_customer(w: Warehouse) -> DataFrame:
    return w.sales.groupBy("customer_id").agg(
        _n().alias("n"), _revenue().alias("revenue"), F.max("transaction_date").alias("last_date")
    )


def customer_lifetime_value(
    w: Warehouse, as_of: dt.date, min_revenue: float = MIN_CLV_REVENUE, top: int | None = TOP_CUSTOMERS
) -> DataFrame:
    """A1: customers by revenue x transactions / days since the last sale."""
    spenders = _per_customer(w).filter(F.col("revenue") > min_revenue)
    names = w.customers.select("customer_id", "first_name", "last_name", "country", "registration_date")
    days = _days_since(as_of, "last_date")
    report = names.join(spenders, "customer_id").select(
        *names.columns,
        F.col("n").alias("total_transactions"),
        _double("revenue", "total_revenue"),
        mean(F.col("revenue"), F.col("n")).alias("avg_transaction_value"),
        F.col("last_date").alias("last_purchase_date"),
        days.alias("days_since_last_purchase"),
        ratio(F.col("revenue") * F.col("n"), F.greatest(days, F.lit(1)), 2).alias("clv_score"),
    )
    report = report.orderBy(F.desc("clv_score"), "customer_id")
    return report if top is None else report.limit(top)


def customer_segmentation(w: Warehouse, as_of: dt.date) -> DataFrame:
    """A2: segment x age band x country, from recency, frequency and spend."""
    days, n, spent = F.col("days"), F.col("n"), F.col("revenue")
    # The first rule that holds names the segment.
    segments = [
        ((days <= 30) & (n >= 5) & (spent >= 2000), "Champions"),
        ((days <= 60) & (n >= 3) & (spent >= 1000), "Loyal Customers"),
        ((days <= 90) & (n >= 2), "Potential Loyalists"),
        ((days <= 30) & (n < 3), "New Customers"),
        ((days > 90) & (spent >= 1000), "At Risk"),
        (days > 180, "Cannot Lose Them"),
    ]
    bands = [(F.col("age") < limit, label) for limit, label in AGE_BANDS]
    buyers = (
        w.customers.select("customer_id", "age", "country")
        .join(_per_customer(w), "customer_id")
        .withColumn("days", _days_since(as_of, "last_date"))
        .select(
            first_match(segments, "Others").alias("customer_segment"),
            first_match(bands, OLDEST_BAND).alias("age_group"),
            "country",
            "revenue",
            "days",
            # a decimal, so that the sum does not depend on the partition order
            mean(spent, n).cast("decimal(28,6)").alias("order_value"),
        )
    )
    size = _n()
    return (
        buyers.groupBy("customer_segment", "age_group", "country")
        .agg(
            size.alias("customer_count"),
            mean(F.sum("revenue"), size).alias("avg_total_spent"),
            mean(F.sum("order_value"), size).alias("avg_order_value"),
            mean(F.sum("days"), size).alias("avg_recency_days"),
        )
        .orderBy(F.desc("customer_count"), "customer_segment", "age_group", "country")
    )


def geographic_performance(w: Warehouse, as_of: dt.date) -> DataFrame:
    """A3: buyers, sales and recent activity per country."""
    recent = F.col("last_date") >= F.date_sub(F.lit(as_of), ACTIVE_DAYS)
    buyers = w.customers.select("customer_id", "country").join(_per_customer(w), "customer_id")
    grouped = buyers.groupBy("country").agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum("n").alias("total_transactions"),
        F.sum("revenue").alias("total_revenue"),
        count_if(recent).alias("active_customers_90d"),
    )
    revenue, n, people = F.col("total_revenue"), F.col("total_transactions"), F.col("total_customers")
    return grouped.select(
        "country",
        "total_customers",
        "total_transactions",
        _double("total_revenue"),
        mean(revenue, n).alias("avg_transaction_value"),
        mean(revenue, people).alias("revenue_per_customer"),
        mean(n, people).alias("transactions_per_customer"),
        "active_customers_90d",
        percent(F.col("active_customers_90d"), people).alias("active_customer_rate"),
    ).orderBy(F.desc("total_revenue"), "country")


def _by_group(rows: DataFrame, *group: str, **sums: Column) -> DataFrame:
    """Totals per group, with the number of distinct customers as `customers`."""
    per_customer = rows.groupBy(*group, "customer_id").agg(*[c.alias(n) for n, c in sums.items()])
    return per_customer.groupBy(*group).agg(
        F.count("customer_id").alias("customers"), *[F.sum(name).alias(name) for name in sums]
    )


def campaign_roi(w: Warehouse) -> DataFrame:
    """A4: return per campaign; campaigns equal in all shown columns merge."""
    group = {"name": "name", "channel": "channel", "budget": "budget", "actual_spend": "spend"}
    sales = w.sales.select("transaction_id", "campaign_id", "customer_id", "amount")
    grouped = _by_group(w.attach(sales, "dim_campaigns", group), *group.values(), n=_n(), revenue=_revenue())
    spend = F.coalesce("spend", F.lit(0))
    revenue = F.col("revenue")
    roi = F.col("roi_percentage")
    ratings = [(roi.isNull(), NO_ROI_RATING), *[(roi >= limit, label) for limit, label in ROI_RATINGS]]
    report = grouped.select(
        F.coalesce("name", F.lit(UNATTRIBUTED)).alias("campaign_name"),
        F.coalesce("channel", F.lit(DIRECT)).alias("channel"),
        F.coalesce("budget", F.lit(0)).cast("double").alias("campaign_budget"),
        spend.cast("double").alias("actual_spend"),
        F.col("n").alias("transactions"),
        F.col("customers").alias("unique_customers"),
        _double("revenue", "total_revenue"),
        mean(revenue, F.col("n")).alias("avg_transaction_value"),
        F.when(spend > 0, percent(revenue - spend, spend)).alias("roi_percentage"),
        F.coalesce(ratio(spend, F.col("customers"), 2), F.lit(0.0)).alias("cost_per_acquisition"),
    )
    return report.withColumn("performance_rating", first_match(ratings, WORST_ROI_RATING)).orderBy(
        F.coalesce(roi, F.lit(NULL_ROI_SORTS_AS)).desc(), F.desc("total_revenue"), "campaign_name", "channel"
    )


def channel_performance(w: Warehouse) -> DataFrame:
    """A5: totals per channel; campaign spend counts once per sale."""
    sales = w.attach(
        w.sales.select("transaction_id", "campaign_id", "customer_id", "amount"),
        "dim_campaigns",
        {"channel": "channel", "actual_spend": "spend"},
    )
    # one row per channel, read twice below
    grouped = checkpointed(
        _by_group(
            sales,
            "channel",
            n=_n(),
            revenue=_revenue(),
            spend=F.sum(F.coalesce("spend", F.lit(0))),
            divisor=F.sum(F.coalesce("spend", F.lit(1))),
        )
    )
    overall = grouped.select(F.sum("revenue")).scalar()
    revenue, divisor = F.col("revenue"), F.col("divisor")
    return grouped.select(
        F.coalesce("channel", F.lit(DIRECT)).alias("channel"),
        F.col("n").alias("total_transactions"),
        _double("revenue", "total_revenue"),
        F.col("customers").alias("unique_customers"),
        mean(revenue, F.col("n")).alias("avg_transaction_value"),
        _double("spend", "total_spend"),
        ratio(revenue, divisor, 2).alias("revenue_per_dollar_spent"),
        ratio(F.col("n"), divisor, 4).alias("transactions_per_dollar_spent"),
        percent(revenue, overall).alias("revenue_share_pct"),
    ).orderBy(F.desc("total_revenue"), "channel")


def product_performance(
    w: Warehouse, min_sales: int = MIN_PRODUCT_SALES, top: int = TOP_PRODUCT_GROUPS
) -> DataFrame:
    """Category x brand by revenue, ranked by revenue and by units.

    Ranks span all groups with enough sales. The revenue rank of the top groups
    only depends on those groups. Their volume rank is one more than the number
    of groups that sold more units, which all groups count in parallel, so no
    task ever holds every group.
    """
    sales = w.attach(
        w.sales.select("transaction_id", "product_id", "customer_id", "quantity", "amount", "unit_price"),
        "dim_products",
        {"category": "category", "brand": "brand", "price": "price"},
        how="inner",
    )
    groups = _by_group(
        sales,
        "category",
        "brand",
        n=_n(),
        units=F.sum("quantity"),
        revenue=_revenue(),
        selling=F.sum("unit_price"),
        catalog=F.sum("price"),
    )
    # one row per category and brand, read three times below
    groups = checkpointed(groups.filter(F.col("n") >= min_sales))
    best = groups.orderBy(F.desc("revenue"), "category", "brand").limit(top)
    levels = best.select(F.collect_set("units")).scalar()
    larger = (
        groups.select("units", levels.alias("levels"))
        .select(F.explode(F.filter("levels", lambda level: level < F.col("units"))).alias("units"))
        .groupBy("units")
        .agg(F.count(F.lit(1)).alias("groups_above"))
    )
    revenue, n = F.col("revenue"), F.col("n")
    # at most `top` rows reach this window
    by_revenue = Window.partitionBy(F.lit(0)).orderBy(F.desc("revenue"))
    return (
        best.withColumn("revenue_rank", F.rank().over(by_revenue).cast("bigint"))
        .join(F.broadcast(larger), "units", "left")
        .select(
            "category",
            "brand",
            n.alias("transaction_count"),
            F.col("units").alias("total_quantity_sold"),
            revenue.cast("double").alias("total_revenue"),
            mean(F.col("selling"), n).alias("avg_selling_price"),
            mean(F.col("catalog"), n).alias("catalog_price"),
            percent(F.col("selling"), F.col("catalog")).alias("price_realization_pct"),
            mean(revenue, F.col("units")).alias("revenue_per_unit"),
            F.col("customers").alias("unique_buyers"),
            "revenue_rank",
            (F.coalesce("groups_above", F.lit(0)) + 1).cast("bigint").alias("volume_rank"),
        )
        .orderBy(F.desc("total_revenue"), "category", "brand")
    )


def inventory_analysis(w: Warehouse, as_of: dt.date, top: int | None = TOP_INVENTORY) -> DataFrame:
    """Movement and stock class of every product, sold or not."""
    sold = w.sales.groupBy("product_id").agg(
        F.sum("quantity").alias("sold"), _revenue().alias("revenue"), F.max("transaction_date").alias("last_date")
    )
    days, units, stock = F.col("days_since_last_sale"), F.col("sold"), F.col("stock_quantity")
    # The first rule that holds names the class.
    movement = [
        (units.isNull(), "No Sales"),
        ((days <= 30) & (units >= 10), "Fast Moving"),
        ((days <= 60) & (units >= 5), "Regular Moving"),
        (days <= 90, "Slow Moving"),
    ]
    levels = [(stock == 0, NO_STOCK), *[(stock <= limit, label) for limit, label in STOCK_LEVELS]]
    order = F.array_position(F.array(*[F.lit(m) for m in MOVEMENT_ORDER]), F.col("inventory_category"))
    report = (
        w.products.select("product_id", "name", "category", "stock_quantity", _double("price", "catalog_price"))
        .join(sold, "product_id", "left")
        .withColumn("days_since_last_sale", _days_since(as_of, "last_date"))
        .select(
            "product_id",
            "name",
            "category",
            "stock_quantity",
            "catalog_price",
            F.coalesce("sold", F.lit(0)).cast("bigint").alias("total_sold"),
            F.coalesce("revenue", F.lit(0)).cast("double").alias("total_revenue"),
            "days_since_last_sale",
            first_match(movement, "Dead Stock").alias("inventory_category"),
            first_match(levels, MUCH_STOCK).alias("stock_status"),
        )
        .orderBy(order, F.desc("total_revenue"), "product_id")
    )
    return report if top is None else report.limit(top)


def monthly_sales(w: Warehouse, since: dt.date | None = None) -> DataFrame:
    """Sales, revenue and buyers per calendar month."""
    sales = w.sales if since is None else w.sales.filter(F.col("transaction_date") >= F.lit(since))
    sales = sales.select(F.trunc("transaction_date", "MONTH").alias("month"), "customer_id", "amount")
    return _by_group(sales, "month", n=_n(), revenue=_revenue())


def seasonal_analysis(w: Warehouse) -> DataFrame:
    """Monthly trend; a month is compared with the previous month that has sales.

    The first month shows growth 0 but falls in the last class, as its growth is
    unknown. The window runs over months, whose number the calendar bounds.
    """
    in_time = Window.partitionBy(F.lit(0)).orderBy("month")
    before = F.lag("revenue").over(in_time)
    recent = in_time.rowsBetween(-2, Window.currentRow)
    trend = monthly_sales(w).select(
        "*",
        percent(F.col("revenue") - before, before).alias("growth"),
        ratio(F.sum("revenue").over(recent), F.count("revenue").over(recent), 2).alias("revenue_3month_avg"),
    )
    growth = F.col("growth")
    return trend.select(
        "month",
        F.col("n").alias("transactions"),
        _double("revenue"),
        F.col("customers").alias("active_customers"),
        mean(F.col("revenue"), F.col("n")).alias("avg_transaction_value"),
        F.coalesce(growth, F.lit(0.0)).alias("mom_revenue_growth_pct"),
        "revenue_3month_avg",
        first_match([(growth >= limit, label) for limit, label in GROWTH_CLASSES], WORST_GROWTH).alias(
            "growth_category"
        ),
    ).orderBy("month")


def cohort_analysis(w: Warehouse, periods: int = COHORT_PERIODS) -> DataFrame:
    """Share of a registration month's customers active n months later.

    Cohorts count all customers. Sales before the registration give negative
    periods and are kept.
    """
    cohort = F.trunc("registration_date", "MONTH").alias("cohort_month")
    customers = w.customers.select("customer_id", cohort)
    active = w.sales.select("customer_id", F.trunc("transaction_date", "MONTH").alias("sold")).distinct()
    offset = 12 * (F.year("sold") - F.year("cohort_month")) + F.month("sold") - F.month("cohort_month")
    counts = (
        active.join(customers, "customer_id")
        .select("cohort_month", offset.cast("bigint").alias("period_number"))
        .filter(F.col("period_number") <= periods)
        .groupBy("cohort_month", "period_number")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    sizes = customers.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    return (
        counts.join(sizes, "cohort_month")
        .select(
            "cohort_month",
            "cohort_size",
            "period_number",
            "active_customers",
            percent(F.col("active_customers"), F.col("cohort_size")).alias("retention_rate"),
        )
        .orderBy("cohort_month", "period_number")
    )


def executive_summary(w: Warehouse, as_of: dt.date) -> DataFrame:
    """A10: one row of key figures."""
    sales = w.sales.select("transaction_id", "customer_id", "product_id", "campaign_id", "transaction_date", "amount")
    sales = w.attach(w.attach(sales, "dim_customers", how="left_semi"), "dim_products", how="left_semi")
    # only campaigns of the dimension count; NO_CAMPAIGN is not one
    sales = w.attach(sales, "dim_campaigns", {"status": "campaign_status"})
    campaign = F.when(F.col("campaign_status").isNotNull() & (F.col("campaign_id") != "NO_CAMPAIGN"), F.col("campaign_id"))
    recent = F.col("transaction_date") >= F.date_sub(F.lit(as_of), RECENT_DAYS)
    # one pass over the sales: each is one narrow row per key, combined on the map side to a row per key and task, so
    # only distinct keys are shuffled; the money goes with the customer
    money, none = F.col("amount"), F.lit(None).cast("decimal(18,2)")
    newest = F.when(recent, money)
    tagged = F.array(
        F.struct(F.lit("customer").alias("kind"), F.col("customer_id").alias("key"), money.alias("amount"), newest.alias("recent")),
        F.struct(F.lit("product").alias("kind"), F.col("product_id").alias("key"), none.alias("amount"), none.alias("recent")),
        F.struct(F.lit("campaign").alias("kind"), campaign.alias("key"), none.alias("amount"), none.alias("recent")),
    )
    keys = sales.select(F.inline(tagged)).filter("key IS NOT NULL").groupBy("kind", "key").agg(
        _n().alias("n"), _revenue().alias("revenue"), F.count("recent").alias("recent_n"), F.sum("recent").alias("recent_revenue")
    )
    of = lambda kind, value: F.when(F.col("kind") == kind, value)
    figures = keys.agg(
        F.coalesce(F.sum(of("customer", F.col("n"))), F.lit(0)).alias("n"),
        F.sum("revenue").alias("revenue"),
        F.coalesce(F.sum("recent_n"), F.lit(0)).alias("recent_n"),
        F.coalesce(F.sum("recent_revenue"), F.lit(0)).alias("recent_revenue"),
        *[F.count(of(kind, F.lit(1))).alias(f"{kind}s") for kind in ("customer", "product", "campaign")],
    )
    c = F.col
    return figures.select(
        F.lit(SUMMARY_TITLE).alias("metric_category"),
        c("n").alias("total_transactions"),
        _double("revenue", "total_revenue"),
        c("customers").alias("total_customers"),
        c("products").alias("products_sold"),
        c("campaigns").alias("active_campaigns"),
        ratio(c("revenue"), c("n"), 2).alias("avg_transaction_value"),
        ratio(c("revenue"), c("customers"), 2).alias("revenue_per_customer"),
        c("recent_n").alias("transactions_last_30d"),
        _double("recent_revenue", "revenue_last_30d"),
        ratio(c("recent_revenue"), c("recent_n"), 2).alias("avg_transaction_value_30d"),
    )


def by_country_category_channel(w: Warehouse, since: dt.date | None = None) -> DataFrame:
    """Sales per country, category and raw channel (null without campaign).

    Sales are first reduced to customer x category x channel; the customer
    lookup then sees few rows per customer, however many sales one made.
    """
    sales = w.sales if since is None else w.sales.filter(F.col("transaction_date") >= F.lit(since))
    sales = sales.select("transaction_id", "customer_id", "product_id", "campaign_id", "amount")
    sales = w.attach(sales, "dim_products", {"category": "category"}, how="inner")
    sales = w.attach(sales, "dim_campaigns", {"channel": "channel", "actual_spend": "spend"})
    per_customer = sales.groupBy("customer_id", "category", "channel").agg(
        _n().alias("n"), _revenue().alias("revenue"), F.sum(F.coalesce("spend", F.lit(0))).alias("spend")
    )
    placed = per_customer.join(w.customers.select("customer_id", "country"), "customer_id")
    return placed.groupBy("country", "category", "channel").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("n").alias("n"),
        F.sum("revenue").alias("revenue"),
        F.sum("spend").alias("spend"),
    )


def attribution_matrix(
    w: Warehouse, min_sales: int = MIN_ATTRIBUTED_SALES, top: int | None = TOP_ATTRIBUTION
) -> DataFrame:
    """Country x category x channel; campaign spend counts once per sale."""
    revenue, n, people, spend = (F.col(x) for x in ("revenue", "n", "customers", "spend"))
    report = (
        by_country_category_channel(w)
        .filter(n >= min_sales)
        .select(
            "country",
            "category",
            F.coalesce("channel", F.lit(DIRECT)).alias("channel"),
            n.alias("transactions"),
            revenue.cast("double").alias("revenue"),
            people.alias("unique_customers"),
            mean(revenue, n).alias("avg_transaction_value"),
            spend.cast("double").alias("marketing_spend"),
            ratio(revenue, people, 2).alias("revenue_per_customer"),
            ratio(n, people, 2).alias("transactions_per_customer"),
            F.when(spend > 0, percent(revenue - spend, spend)).alias("roi_percentage"),
        )
        .orderBy(F.desc("revenue"), "country", "category", "channel")
    )
    return report if top is None else report.limit(top)
