"""Data-quality checks of the warehouse and their roll-up.

Every check reduces each table to counts before anything else: one aggregate per
table for completeness, freshness and volume (`profile`), one count per key for
uniqueness and foreign keys. Thresholds are parameters with the usual values as
defaults.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketwork.functions.numbers import count_if, first_match, percent
from basketwork.operators.joins import matched_keys
from basketwork.operators.warehouse import KEYS, Warehouse
from basketwork.session import checkpointed
from basketwork.sources.tables import small_table

# Check names, thresholds, statuses and texts.
UNIQUENESS, COMPLETENESS = "UNIQUENESS_CHECK", "COMPLETENESS_CHECK"
FOREIGN_KEYS, UTILISATION = "FOREIGN_KEY_INTEGRITY", "DIMENSION_UTILIZATION"
FRESHNESS, VOLUME = "FRESHNESS_CHECK", "VOLUME_CHECK"
ALL_TABLES = "ALL_TABLES"
EMAIL_CHECK = "dim_customers_email"
CRITICAL_COLUMNS = {
    "dim_customers": ["customer_id", "first_name", "last_name", "email", "country"],
    "dim_products": ["product_id", "name", "category", "price", "availability"],
    "dim_campaigns": ["campaign_id", "name", "channel", "budget", "start_date"],
    "fact_sales_transactions": ["transaction_id", "customer_id", "product_id", "amount", "transaction_date"],
}
COMPLETENESS_LEVELS = [
    (95, "PASS", "Excellent data completeness"),
    (90, "WARNING", "Acceptable with minor gaps"),
]
COMPLETENESS_BELOW = ("FAIL", "Critical completeness issues")
FOREIGN_KEY_LEVELS = [
    (100, "PASS", "All foreign keys valid"),
    (95, "WARNING", "Minor integrity violations detected"),
]
FOREIGN_KEY_BELOW = ("FAIL", "Critical integrity violations")
FULLY_USED = ("OPTIMAL", "All dimensions fully utilized")
UTILISATION_LEVELS = [
    (50, "GOOD", "Good dimension utilization"),
    (25, "WARNING", "Some unused dimension records"),
]
UTILISATION_BELOW = ("POOR", "Poor dimension utilization")
FRESHNESS_LEVELS = [
    (24, "FRESH", "Data is fresh (< 24 hours)"),
    (48, "ACCEPTABLE", "Data is acceptable (< 48 hours)"),
    (168, "AGING", "Data is aging (< 1 week)"),
]
FRESHNESS_BEYOND = ("STALE", "Data is stale (> 1 week)")
LOAD_TIMES = {
    "dim_customers": "created_date",
    "dim_products": "created_date",
    "dim_campaigns": "created_date",
    "fact_sales_transactions": "created_timestamp",
}
SPANS_IN_DATES = ["dim_customers", "dim_products"]
EXPECTED_VOLUMES = {
    "dim_customers": (8000, 12000),
    "dim_products": (5, 1000),
    "dim_campaigns": (5, 2000),
    "fact_sales_transactions": (1000, 100000),
}
VOLUME_CLASSES = {
    "CRITICAL": ("No data found - critical issue", "Check data ingestion pipeline"),
    "LOW": ("Volume below expected minimum", "Investigate potential data loss"),
    "HIGH": ("Volume exceeds expected maximum", "Check for data duplication"),
    "NORMAL": ("Volume within expected range", "No action required"),
}
FACT_PREFIX = "fact_transactions_to_"
ORPHAN_SUFFIX = "_orphaned"
BAD_STATUSES = ["FAIL", "CRITICAL"]
UNHEALTHY, HEALTHY = "UNHEALTHY", "HEALTHY"


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _at(as_of: dt.datetime | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of)


def uniqueness(
    keyed: Mapping[str, tuple[DataFrame, str]], as_of: dt.datetime | None = None
) -> DataFrame:
    """Q1: duplicated keys per table; a single PASS row when there are none.

    `keyed` maps the shown name to a frame and its key (see `unique_keys`).
    """
    violations = []
    for name, (df, key) in keyed.items():
        repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        violations.append(
            repeated.agg(
                F.count(F.lit(1)).alias("violation_count"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("total_duplicates"),
            ).select(F.lit(name).alias("table_name"), "*")
        )
    counts = _union(violations)
    found = counts.filter(F.col("violation_count") > 0).withColumn("check_status", F.lit("FAIL"))
    clean = (
        counts.agg(F.sum("violation_count").alias("violation_count"), F.sum("total_duplicates").alias("total_duplicates"))
        .filter(F.col("violation_count") == 0)
        .select(F.lit(ALL_TABLES).alias("table_name"), "*", F.lit("PASS").alias("check_status"))
    )
    return (
        found.unionByName(clean)
        .withColumns({"check_timestamp": _at(as_of), "check_type": F.lit(UNIQUENESS)})
        .select("table_name", "violation_count", "total_duplicates", "check_timestamp", "check_type", "check_status")
        .orderBy("table_name")
    )


def unique_keys(w: Warehouse) -> dict[str, tuple[DataFrame, str]]:
    """The keys that must be unique: four primary keys and the customer email."""
    keyed = {name: (df, KEYS[name]) for name, df in w.tables.items()}
    emails = w.customers.select("email").filter(F.col("email").isNotNull())
    return {**keyed, EMAIL_CHECK: (emails, "email")}


def profile(
    w: Warehouse,
    columns: Mapping[str, Sequence[str]] = CRITICAL_COLUMNS,
    times: Mapping[str, str] = LOAD_TIMES,
) -> DataFrame:
    """One row per table: records, filled critical cells, newest and oldest load.

    A single scan per table serves completeness, freshness and volume; unused
    figures are pruned from the scan.
    """
    rows = []
    for name, df in w.tables.items():
        filled = reduce(Column.__add__, [F.count(c) for c in columns[name]])
        time = F.col(times[name]).cast("timestamp")
        rows.append(
            df.agg(
                F.count(F.lit(1)).alias("total_records"),
                filled.alias("filled_cells"),
                F.max(time).alias("latest"),
                F.min(time).alias("oldest"),
            ).select(F.lit(name).alias("table_name"), "*", F.lit(len(columns[name])).alias("critical_columns"))
        )
    return _union(rows)


def completeness(
    table_profile: DataFrame,
    as_of: dt.datetime | None = None,
    levels: Sequence[tuple[float, str, str]] = COMPLETENESS_LEVELS,
) -> DataFrame:
    """Q2: share of filled critical cells; an empty table fails."""
    pct = percent(F.col("filled_cells"), F.col("total_records") * F.col("critical_columns"))
    score = F.col("overall_completeness_pct")
    return (
        table_profile.select("table_name", "total_records", pct.alias("overall_completeness_pct"))
        .withColumns(
            {
                "check_timestamp": _at(as_of),
                "check_type": F.lit(COMPLETENESS),
                "check_status": first_match([(score >= n, s) for n, s, _ in levels], COMPLETENESS_BELOW[0]),
                "status_description": first_match([(score >= n, t) for n, _, t in levels], COMPLETENESS_BELOW[1]),
            }
        )
        .orderBy(F.desc("overall_completeness_pct"), "table_name")
    )


def column_completeness(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Filled share of single columns, one row per column."""
    counts = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in columns])
    return counts.unpivot("__n", list(columns), "column_name", "filled").select(
        F.lit(name).alias("table_name"), "column_name", percent(F.col("filled"), F.col("__n")).alias("completeness_pct")
    )


def integrity_counts(w: Warehouse, per_dimension: bool = False) -> DataFrame:
    """Rows, orphans and share for the three foreign keys, in both directions.

    One pass over the sales counts all three keys before they meet the dimensions, so the
    join sees one row per key. A utilisation row counts joined rows: every sale of a used
    dimension row and one for each unused row; `per_dimension` counts dimension
    rows instead.
    """
    names = ("dim_customers", "dim_products", "dim_campaigns")
    pairs = matched_keys(w.sales, {name: (w.tables[name], KEYS[name]) for name in names})
    facts, dims = F.col("n_rows"), F.col("n_dim")
    totals = pairs.groupBy("dimension").agg(
        F.sum(facts * F.coalesce(dims, F.lit(1))).alias("fact_total"),
        F.sum(F.when(dims.isNull(), facts)).alias("fact_orphans"),
        F.sum(dims if per_dimension else dims * F.coalesce(facts, F.lit(1))).alias("dim_total"),
        F.sum(F.when(facts.isNull(), dims)).alias("dim_orphans"),
    )
    listed = small_table(w.sales.sparkSession, [(name,) for name in names], ["dimension"])
    figures = listed.join(totals, "dimension", "left").na.fill(0)
    labels = (
        (F.concat(F.lit(FACT_PREFIX), "dimension"), FOREIGN_KEYS, "fact_total", "fact_orphans"),
        (F.concat("dimension", F.lit(ORPHAN_SUFFIX)), UTILISATION, "dim_total", "dim_orphans"),
    )
    both = F.array(
        *[
            F.struct(
                label.alias("relationship_name"),
                F.col(total).alias("total_records"),
                F.col(orphans).alias("orphaned_records"),
                percent(F.col(total) - F.col(orphans), F.col(total)).alias("percentage"),
                F.lit(check).alias("check_type"),
            )
            for label, check, total, orphans in labels
        ]
    )
    return figures.select(F.inline(both))


def integrity(w: Warehouse, as_of: dt.datetime | None = None, per_dimension: bool = False) -> DataFrame:
    """Q3-Q5: foreign keys and dimension use with status and text."""
    pct, orphans = F.col("percentage"), F.col("orphaned_records")
    is_fk = F.col("check_type") == FOREIGN_KEYS
    used = F.col("check_type") == UTILISATION
    rules = [(is_fk & (pct >= n), s, t) for n, s, t in FOREIGN_KEY_LEVELS]
    rules.append((is_fk, *FOREIGN_KEY_BELOW))
    rules.append((used & (orphans == 0), *FULLY_USED))
    rules += [(used & (pct >= n), s, t) for n, s, t in UTILISATION_LEVELS]
    status = first_match([(rule, s) for rule, s, _ in rules], UTILISATION_BELOW[0])
    text = first_match([(rule, t) for rule, _, t in rules], UTILISATION_BELOW[1])
    return (
        integrity_counts(w, per_dimension)
        .withColumns({"check_status": status, "check_timestamp": _at(as_of), "status_description": text})
        .orderBy("check_type", "check_status", "relationship_name")
    )


def freshness(
    table_profile: DataFrame,
    as_of: dt.datetime | None = None,
    levels: Sequence[tuple[float, str, str]] = FRESHNESS_LEVELS,
) -> DataFrame:
    """Q6: whole hours since the newest load; an empty table is stale."""
    now = _at(as_of)
    hours = F.col("hours_since_latest")
    in_dates = F.datediff("latest", "oldest").cast("bigint")
    in_days = F.timestamp_diff("DAY", F.col("oldest"), F.col("latest"))
    return (
        table_profile.select(
            "table_name",
            "total_records",
            F.col("latest").alias("latest_data_timestamp"),
            F.timestamp_diff("HOUR", F.col("latest"), now).alias("hours_since_latest"),
            F.when(F.col("table_name").isin(SPANS_IN_DATES), in_dates).otherwise(in_days).alias("data_age_span_days"),
        )
        .withColumns(
            {
                "check_timestamp": now,
                "check_type": F.lit(FRESHNESS),
                "freshness_status": first_match([(hours <= n, s) for n, s, _ in levels], FRESHNESS_BEYOND[0]),
                "status_description": first_match([(hours <= n, t) for n, _, t in levels], FRESHNESS_BEYOND[1]),
            }
        )
        .orderBy(F.desc_nulls_last("hours_since_latest"), "table_name")
    )


def volume(
    table_profile: DataFrame,
    as_of: dt.datetime | None = None,
    expected: Mapping[str, tuple[int, int]] = EXPECTED_VOLUMES,
) -> DataFrame:
    """Q7: row counts against the expected range of each table."""
    ranges = small_table(
        table_profile.sparkSession,
        [(name, low, high) for name, (low, high) in expected.items()],
        ["table_name", "min_expected", "max_expected"],
    )
    n = F.col("actual_count")
    status = first_match(
        [(n == 0, "CRITICAL"), (n < F.col("min_expected"), "LOW"), (n > F.col("max_expected"), "HIGH")], "NORMAL"
    )
    names = list(VOLUME_CLASSES)
    severity = F.array_position(F.array(*[F.lit(s) for s in names]), F.col("volume_status"))

    def text(i: int) -> Column:
        return first_match([(F.col("volume_status") == s, VOLUME_CLASSES[s][i]) for s in names], None)

    return (
        table_profile.select("table_name", F.col("total_records").alias("actual_count"))
        .join(ranges, "table_name")
        .withColumn("volume_percentage", percent(n, F.col("max_expected")))
        .withColumns({"check_timestamp": _at(as_of), "check_type": F.lit(VOLUME), "volume_status": status})
        .withColumns({"status_description": text(0), "recommended_action": text(1)})
        .orderBy(severity, "table_name")
    )


def as_results(checks: Sequence[DataFrame]) -> DataFrame:
    """Q8: any of the check outputs in the shape of the result table."""
    return _union([_as_result(check) for check in checks])


def _as_result(check: DataFrame) -> DataFrame:
    """Metric and threshold depend on the kind of check, told by its columns."""
    c = F.col
    if "violation_count" in check.columns:
        shape = ("table_name", "check_status", c("violation_count"), F.lit(0))
    elif "overall_completeness_pct" in check.columns:
        shape = ("table_name", "check_status", c("overall_completeness_pct"), F.lit(COMPLETENESS_LEVELS[0][0]))
    elif "hours_since_latest" in check.columns:
        shape = ("table_name", "freshness_status", c("hours_since_latest"), F.lit(FRESHNESS_LEVELS[0][0]))
    elif "volume_status" in check.columns:
        shape = ("table_name", "volume_status", c("actual_count"), c("max_expected"))
    else:
        is_fk = c("check_type") == FOREIGN_KEYS
        limit = F.when(is_fk, FOREIGN_KEY_LEVELS[0][0]).otherwise(UTILISATION_LEVELS[0][0])
        shape = ("relationship_name", "check_status", c("percentage"), limit)
    table, status, metric, threshold = shape

    def text(name: str) -> Column:
        return (c(name) if name in check.columns else F.lit(None).cast("string")).alias(name)

    return check.select(
        c(table).alias("table_name"),
        "check_type",
        c(status).alias("check_status"),
        "check_timestamp",
        metric.cast("double").alias("metric_value"),
        threshold.cast("double").alias("threshold_value"),
        text("status_description"),
        text("recommended_action"),
    )


def run_all(w: Warehouse, as_of: dt.datetime | None = None, times: Mapping[str, str] = LOAD_TIMES) -> DataFrame:
    """All checks of one run as result rows."""
    figures = checkpointed(profile(w, times=times))  # four rows, read by three checks
    return as_results(
        [
            uniqueness(unique_keys(w), as_of),
            completeness(figures, as_of),
            integrity(w, as_of),
            freshness(figures, as_of),
            volume(figures, as_of),
        ]
    )


def health(results: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Q9: a day's results by type and status, with the overall health.

    A day without results has no rows here; `system_health` calls it healthy.
    """
    # the window sees one row per type and status, a handful whatever the number of results
    bad = F.max(F.col("check_status").isin(BAD_STATUSES)).over(Window.partitionBy())
    return (
        _of_day(results, day).groupBy("check_type", "check_status")
        .agg(F.count(F.lit(1)).alias("check_count"))
        .withColumn("system_health", F.when(bad, UNHEALTHY).otherwise(HEALTHY))
        .orderBy("check_type", "check_status")
    )


def _of_day(results: DataFrame, day: dt.date | None) -> DataFrame:
    return results.filter(F.to_date("check_timestamp") == (F.current_date() if day is None else F.lit(day)))


def system_health(results: DataFrame, day: dt.date | None = None) -> DataFrame:
    """One row: UNHEALTHY when any check of the day failed or was critical."""
    bad = count_if(F.col("check_status").isin(BAD_STATUSES))
    return _of_day(results, day).agg(F.when(bad > 0, UNHEALTHY).otherwise(HEALTHY).alias("system_health"))


def latest_results(results: DataFrame, top: int | None = 20) -> DataFrame:
    """M1: the newest check results."""
    return results.orderBy(F.desc("check_timestamp"), "check_type", "table_name").transform(lambda rows: rows if top is None else rows.limit(top))


def result_patterns(results: DataFrame) -> DataFrame:
    """M4: how often each check ends in each status, with mean and least metric."""
    metric = F.col("metric_value").cast("decimal(28,6)")
    n = F.count("metric_value")
    return (
        results.groupBy("check_type", "check_status")
        .agg(
            F.count(F.lit(1)).alias("frequency"),
            (F.sum(metric).cast("double") / F.nullif(n, F.lit(0))).alias("avg_score"),
            F.min("metric_value").alias("min_score"),
        )
        .orderBy(F.desc("frequency"), "check_type", "check_status")
    )
