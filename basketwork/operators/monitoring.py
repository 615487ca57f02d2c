"""Documented business rules, key figures and service levels.

These extend the coded checks: campaign date windows, rule violations, campaign
and customer key figures, daily volumes, health score, severity, slow steps and
quarantine. All limits are parameters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketwork.functions.numbers import count_if, first_match, mean, percent, ratio
from basketwork.operators.lineage import FAILED, RUNNING, executions
from basketwork.operators.quality import (
    COMPLETENESS, FOREIGN_KEYS, FRESHNESS, UNIQUENESS, VOLUME, column_completeness,
)
from basketwork.operators.joins import attach, column_bytes, last_before
from basketwork.operators.warehouse import Warehouse
from basketwork.session import checkpointed
from basketwork.sources.tables import append_rows, small_table, stored_or_empty

# Documented limits.
DAILY_SALES = (50, 500)
DAILY_NEW_CUSTOMERS = (10, 100)
CATALOGUE_CHANGE_PCT = 10
CONCURRENT_CAMPAIGNS = (1, 20)
COMPLETENESS_LIMITS = {
    "dim_customers": (95, ["email", "country", "registration_date"]),
    "dim_products": (98, ["name", "category", "price"]),
    "dim_campaigns": (90, ["name", "channel", "start_date", "end_date"]),
    "fact_sales_transactions": (99, ["customer_id", "product_id", "amount"]),
}
HEALTH_LEVELS = [(95, "PRODUCTION_READY"), (90, "WARNING")]
HEALTH_BELOW = "CRITICAL"
SLOW_PCT, VERY_SLOW_FACTOR = 20, 5
EXPECTED_RECORDS = {
    "customers": 10000, "products": 500, "marketing_campaigns": 1000, "sales_transactions": 50000,
}


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _range_status(value: Column, limits: tuple[int, int]) -> Column:
    low, high = limits
    return first_match([(value < low, "LOW"), (value > high, "HIGH")], "NORMAL")


def outside_campaign_window(w: Warehouse) -> DataFrame:
    """Sales dated before the start or after the end of their campaign."""
    sales = w.sales.select("transaction_id", "campaign_id", "transaction_date")
    dated = w.attach(sales, "dim_campaigns", {"start_date": "start_date", "end_date": "end_date"}, how="inner")
    return dated.filter(~F.col("transaction_date").between(F.col("start_date"), F.col("end_date"))).select(
        "transaction_id", "campaign_id", "transaction_date", "start_date", "end_date"
    )


def rule_violations(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Staging rows that break a business rule, one row per rule."""
    c = F.col
    sales = feeds["sales_transactions"].agg(
        F.count(F.lit(1)).alias("n"),
        count_if(c("quantity") <= 0).alias("positive_quantity"),
        count_if(c("unit_price") <= 0).alias("positive_unit_price"),
        count_if(c("discount_amount").cast("decimal(18,2)") > c("quantity") * c("unit_price").cast("decimal(18,2)")).alias(
            "discount_within_gross"
        ),
    )
    campaigns = feeds["marketing_campaigns"].agg(
        F.count(F.lit(1)).alias("n"), count_if(c("end_date") < c("start_date")).alias("end_not_before_start")
    )
    return _union(
        [
            df.unpivot("n", [x for x in df.columns if x != "n"], "rule", "violations").select(
                "rule", F.col("n").alias("checked"), "violations"
            )
            for df in (sales, campaigns)
        ]
    )


def campaign_kpis(w: Warehouse) -> DataFrame:
    """D3: return on spend, cost per conversion and conversion rate of each campaign."""
    revenue = w.sales.groupBy("campaign_id").agg(F.sum("amount").alias("revenue"))
    spend, clicks, conversions = F.col("actual_spend"), F.col("clicks"), F.col("conversions")
    return (
        w.campaigns.select("campaign_id", "actual_spend", "clicks", "conversions")
        .join(revenue, "campaign_id", "left")
        .select(
            "campaign_id",
            F.coalesce("revenue", F.lit(0)).cast("double").alias("revenue"),
            ratio(F.coalesce("revenue", F.lit(0)), spend, 4).alias("roas"),
            ratio(spend, conversions, 4).alias("cost_per_acquisition"),
            percent(conversions, clicks, 4).alias("conversion_rate"),
        )
    )


def business_kpis(w: Warehouse) -> DataFrame:
    """D3: retention, acquisition cost and inventory turnover in one row.

    Retention is the share of customers with more than one sale. The acquisition
    cost spreads all campaign spend over the customers who bought. Turnover is
    units sold over units in stock.
    """
    buyers = w.sales.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("units"))
    totals = buyers.agg(
        F.count(F.lit(1)).alias("buyers"), count_if(F.col("n") > 1).alias("repeat"), F.sum("units").alias("units")
    )
    customers = w.customers.select(F.count(F.lit(1))).scalar()
    spend = w.campaigns.select(F.sum("actual_spend")).scalar()
    stock = w.products.select(F.sum("stock_quantity")).scalar()
    return totals.select(
        percent(F.col("repeat"), customers).alias("retention_rate"),
        ratio(spend, F.col("buyers"), 2).alias("customer_acquisition_cost"),
        ratio(F.col("units"), stock, 4).alias("inventory_turnover"),
    )


def daily_volumes(w: Warehouse) -> DataFrame:
    """Sales and new customers per day against their expected ranges."""
    parts = (
        (w.sales, "transaction_date", "sales", DAILY_SALES),
        (w.customers, "registration_date", "new_customers", DAILY_NEW_CUSTOMERS),
    )
    return _union(
        [
            df.groupBy(F.col(day).alias("day"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("day", F.lit(metric).alias("metric"), "n", _range_status(F.col("n"), limits).alias("status"))
            for df, day, metric, limits in parts
        ]
    )


def concurrent_campaigns(w: Warehouse, limits: tuple[int, int] = CONCURRENT_CAMPAIGNS) -> DataFrame:
    """Running campaigns from each day on which their number changes.

    Starts add one and the day after an end takes one away; the running total
    goes over calendar days, of which there are few, instead of listing every
    day of every campaign.
    """
    starts = w.campaigns.select(F.col("start_date").alias("day"), F.lit(1).alias("change"))
    ends = w.campaigns.select(F.date_add("end_date", 1).alias("day"), F.lit(-1).alias("change"))
    changes = starts.unionByName(ends).groupBy("day").agg(F.sum("change").alias("change"))
    running = F.sum("change").over(
        Window.partitionBy(F.lit(0)).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return changes.select("day", running.alias("active_campaigns")).withColumn(
        "status", _range_status(F.col("active_campaigns"), limits)
    )


def catalogue_change(w: Warehouse, previous_count: int, limit_pct: float = CATALOGUE_CHANGE_PCT) -> DataFrame:
    """Change of the number of products against an earlier count."""
    change = percent(F.col("n") - F.lit(previous_count), F.lit(previous_count))
    return w.products.agg(F.count(F.lit(1)).alias("n")).select(
        F.col("n").alias("product_count"),
        change.alias("change_pct"),
        F.when(F.abs(change) <= limit_pct, "NORMAL").otherwise("ANOMALY").alias("status"),
    )


def known_products(w: Warehouse) -> DataFrame:
    """day, product_count: products sold up to and including each day on which one is sold for the first time."""
    first = w.sales.groupBy("product_id").agg(F.min("transaction_date").alias("day"))
    new = first.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row per day
    return new.select("day", F.sum("n").over(so_far).alias("product_count"))


def take_snapshots(counts: DataFrame, path: str) -> None:
    """Append the catalogue's count of given days (day, product_count) to the stored snapshots.

    Days that have a snapshot keep it.
    """
    there = stored_or_empty(counts.sparkSession, path, counts.schema)
    append_rows(counts.join(checkpointed(there.select("day")), "day", "left_anti"), path)


def change_since_snapshot(counts: DataFrame, snapshots: DataFrame, limit_pct: float = CATALOGUE_CHANGE_PCT) -> DataFrame:
    """Each day's product count against the last snapshot stored before that day; NO_SNAPSHOT without one."""
    taken = snapshots.select(F.col("day").alias("snapshot_day"), F.col("product_count").alias("previous_count"))
    compared = last_before(counts, "day", taken, "snapshot_day")
    change = percent(F.col("product_count") - F.col("previous_count"), F.col("previous_count"))
    rules = [(F.col("snapshot_day").isNull(), "NO_SNAPSHOT"), (F.abs(change) <= limit_pct, "NORMAL")]
    return compared.select(
        "day", "product_count", "snapshot_day", "previous_count", change.alias("change_pct"), first_match(rules, "ANOMALY").alias("status")
    )


def completeness_limits(w: Warehouse, limits: Mapping[str, tuple[float, list[str]]] = COMPLETENESS_LIMITS) -> DataFrame:
    """Filled share of named columns against the limit of their table."""
    rows = []
    for name, (limit, columns) in limits.items():
        shares = column_completeness(w.tables[name], name, columns)
        met = F.coalesce(F.col("completeness_pct") >= limit, F.lit(False))
        rows.append(shares.select("*", F.lit(float(limit)).alias("limit_pct"), F.when(met, "PASS").otherwise("FAIL").alias("status")))
    return _union(rows)


def health_score(results: DataFrame, log: DataFrame, max_seconds: int = 300) -> DataFrame:
    """Mean of quality, performance and availability in percent.

    Quality: mean of completeness, key integrity and passed uniqueness checks.
    Performance: finished steps within `max_seconds`. Availability: finished
    steps that did not fail.
    """
    passed = F.when(F.col("check_status") == "PASS", 100.0).otherwise(0.0)
    scores = results.filter(F.col("check_type").isin(COMPLETENESS, FOREIGN_KEYS, UNIQUENESS)).select(
        F.when(F.col("check_type") == UNIQUENESS, passed).otherwise(F.col("metric_value")).cast("decimal(18,6)").alias("s")
    )
    quality = scores.select(mean(F.sum("s"), F.count("s"))).scalar()
    finished = executions(log).filter(F.col("execution_status") != RUNNING)
    n = F.count(F.lit(1))
    parts = finished.agg(
        (100 * mean(count_if(F.col("execution_duration_seconds") <= max_seconds), n)).alias("performance_score"),
        (100 * mean(count_if(F.col("execution_status") != FAILED), n)).alias("availability_score"),
    ).select(quality.alias("quality_score"), "*")
    overall = (F.col("quality_score") + F.col("performance_score") + F.col("availability_score")) / 3
    score = F.col("health_score")
    return parts.withColumn("health_score", overall).withColumn(
        "health_level", first_match([(score >= limit, label) for limit, label in HEALTH_LEVELS], HEALTH_BELOW)
    )


def severities(results: DataFrame) -> DataFrame:
    """Severity P0 (worst) to P3 of each check result."""
    kind, status, metric = F.col("check_type"), F.col("check_status"), F.col("metric_value")
    scored = kind.isin(COMPLETENESS, FOREIGN_KEYS)
    rules = [
        ((kind == VOLUME) & (status == "CRITICAL"), "P0"),
        ((kind == UNIQUENESS) & (status == "FAIL"), "P1"),
        ((kind == FOREIGN_KEYS) & (metric < 95), "P1"),
        (scored & (metric < 90), "P1"),
        (scored & (metric < 95), "P2"),
        ((kind == FRESHNESS) & status.isin("AGING", "STALE"), "P2"),
    ]
    return results.select("table_name", "check_type", "check_status", "metric_value", first_match(rules, "P3").alias("severity"))


def slow_steps(log: DataFrame) -> DataFrame:
    """Finished executions much slower than the mean of their step."""
    finished = executions(log).filter(F.col("execution_status") != RUNNING).select(
        "execution_id", "dag_id", "task_id", "execution_duration_seconds"
    )
    step = F.concat_ws("/", "dag_id", "task_id").alias("step")
    # one row per step, averaged before it meets the executions
    usual = checkpointed(
        finished.groupBy(step).agg(
            mean(F.sum("execution_duration_seconds"), F.count("execution_duration_seconds")).alias("baseline_seconds")
        )
    )
    size = sum(column_bytes(usual).values())
    timed = attach(finished.select("*", step), usual, "step", "inner", size, salt_on="execution_id")
    seconds, baseline = F.col("execution_duration_seconds"), F.col("baseline_seconds")
    rules = [
        (seconds > VERY_SLOW_FACTOR * baseline, "CRITICAL"),
        (seconds * 100 > (100 + SLOW_PCT) * baseline, "DEGRADED"),
    ]
    return (
        timed.withColumn("alert", first_match(rules, "OK"))
        .filter(F.col("alert") != "OK")
        .select("execution_id", "dag_id", "task_id", "execution_duration_seconds", "baseline_seconds", "alert")
    )


def with_reasons(sales: DataFrame) -> DataFrame:
    """Sales with the quality rules they break as `reasons`."""
    c = F.col
    rules = {
        "amount_differs": ~c("amount_calculation_valid"),
        "unknown_payment_method": ~c("payment_method_valid"),
        "unknown_status": ~c("status_valid"),
        "date_missing": c("transaction_date") == F.lit(dt.date(1900, 1, 1)),
    }
    return sales.withColumn("reasons", F.concat_ws(",", *[F.when(rule, F.lit(name)) for name, rule in rules.items()]))


def quarantine(sales: DataFrame, path: str) -> None:
    """Write sales once, those that keep all rules under `verdict=good`, others under `verdict=bad`."""
    marked = with_reasons(sales).withColumn("verdict", F.when(F.col("reasons") == "", "good").otherwise("bad"))
    marked.write.mode("overwrite").partitionBy("verdict").parquet(path)


def daily_sales(w: Warehouse) -> DataFrame:
    """An aggregate worth storing: sales per day and payment method."""
    return w.sales.groupBy("transaction_date", "payment_method").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount").alias("revenue"), F.sum("quantity").alias("units")
    )


def expected_records(feeds: Mapping[str, DataFrame], expected: Mapping[str, int] = EXPECTED_RECORDS) -> DataFrame:
    """Delivered against expected records per feed, with the total."""
    counts = _union(
        [
            df.agg(F.count(F.lit(1)).alias("actual_records")).select(F.lit(name).alias("feed"), "actual_records")
            for name, df in feeds.items()
        ]
    )
    wanted = small_table(counts.sparkSession, list(expected.items()), ["feed", "expected_records"])
    joined = counts.join(wanted, "feed")
    total = joined.agg(F.sum("actual_records").alias("actual_records"), F.sum("expected_records").alias("expected_records"))
    rows = joined.unionByName(total.select(F.lit("total").alias("feed"), "*"))
    return rows.select(
        "feed", "actual_records", "expected_records",
        percent(F.col("actual_records"), F.col("expected_records")).alias("delivered_pct"),
    )
