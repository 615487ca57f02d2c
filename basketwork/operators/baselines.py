"""Baselines from earlier days: robust volume checks (Q7) and slow steps.

A day is judged by the days before it inside a time frame, never by itself, so an outlier cannot hide in its own
baseline. Medians are exact. They are taken over what keeps for good and merges: one count per day, or the number of
runs per day and duration. So a step that holds most runs costs one row per duration and day.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketwork.functions.numbers import first_match
from basketwork.operators.joins import attach, column_bytes
from basketwork.operators.lineage import RUNNING, executions
from basketwork.operators.quality import VOLUME
from basketwork.session import checkpointed

# Documented tolerance, and limits of the robust rule.
TOLERANCE_PCT = 20
WINDOW_DAYS, MIN_DAYS = 28, 7
DEVIATIONS, NORMAL_MAD = 3.0, 1.4826
STEP_DAYS = 14
SLOW_PCT, VERY_SLOW_FACTOR = 20, 5


def median(values: Column) -> Column:
    """Median of an array of numbers: the middle one, or the mean of the two in the middle; null if empty."""
    ordered, n = F.array_sort(values), F.size(values)
    low, high = (F.get(ordered, F.floor(x).cast("int")) for x in ((n - 1) / 2, n / 2))
    return F.when(n > 0, (low.cast("double") + high) / 2)


def deviation(values: Column, middle: Column) -> Column:
    """Median absolute deviation of an array from its median."""
    return median(F.transform(values, lambda v: F.abs(v.cast("double") - middle)))


def daily_counts(tables: Mapping[str, tuple[DataFrame, str]], since) -> DataFrame:
    """table_name, day, n: rows of each table per value of its date column from `since` on."""
    parts = [
        df.filter(F.col(day) >= F.lit(since)).groupBy(F.col(day).alias("day"))
        .agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "day", "n")
        for name, (df, day) in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def volume_history(results: DataFrame) -> DataFrame:
    """table_name, day, n from stored volume checks (Q8): the last count of each table and day."""
    counts = results.filter(F.col("check_type") == VOLUME)
    return counts.groupBy("table_name", F.to_date("check_timestamp").alias("day")).agg(
        F.max_by("metric_value", "check_timestamp").cast("bigint").alias("n")
    )


def every_day(history: DataFrame) -> DataFrame:
    """The history with a zero for each day without rows between a table's first and last day."""
    ends = history.groupBy("table_name").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    days = ends.select("table_name", F.explode(F.sequence("first", "last")).alias("day"))
    return days.join(history, ["table_name", "day"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def volume_statistical(
    history: DataFrame, window_days: int = WINDOW_DAYS, min_days: int = MIN_DAYS,
    tolerance_pct: float = TOLERANCE_PCT, deviations: float = DEVIATIONS,
) -> DataFrame:
    """Q7 by statistics: each day's count against the median of the `window_days` days before it.

    `history` holds table_name, day and n, at most one row per table and day. A count is NORMAL within
    `tolerance_pct` of the median and also within `deviations` robust standard deviations of it (the median absolute
    deviation scaled to a normal distribution); beyond both it is LOW or HIGH. A count of zero is CRITICAL. With fewer
    than `min_days` days in the frame there is no verdict (NO_BASELINE), whatever the count. A window holds one row
    per day, so the calendar bounds it.
    """
    at = F.datediff("day", F.lit("1970-01-01"))
    frame = Window.partitionBy("table_name").orderBy(at).rangeBetween(-window_days, -1)
    before = F.col("before")
    framed = history.select("table_name", "day", "n", F.collect_list("n").over(frame).alias("before"))
    middle = framed.withColumn("median_count", median(before))
    spread = middle.withColumn("mad", deviation(before, F.col("median_count")))
    reach = F.greatest(F.col("median_count") * (tolerance_pct / 100), F.col("mad") * (deviations * NORMAL_MAD))
    n, enough = F.col("n"), F.size("before") >= min_days
    rules = [
        (~enough, "NO_BASELINE"), (n == 0, "CRITICAL"), (n < F.col("lower_bound"), "LOW"), (n > F.col("upper_bound"), "HIGH"),
    ]
    bounds = {"lower_bound": F.col("median_count") - reach, "upper_bound": F.col("median_count") + reach}
    return spread.withColumns(bounds).select(
        "table_name", "day", F.col("n").alias("actual_count"), F.size("before").cast("bigint").alias("history_days"),
        "median_count", "mad", *(F.round(b, 6).alias(b) for b in bounds), first_match(rules, "NORMAL").alias("volume_status"),
    )


def step_histogram(log: DataFrame) -> DataFrame:
    """step, day, seconds, runs: finished runs by duration. Histograms of days, or of parts of a day, add up."""
    done = executions(log).filter((F.col("execution_status") != RUNNING) & F.col("execution_duration_seconds").isNotNull())
    return done.groupBy(
        F.concat_ws("/", "dag_id", "task_id").alias("step"), F.to_date("start_time").alias("day"),
        F.col("execution_duration_seconds").alias("seconds"),
    ).agg(F.count(F.lit(1)).alias("runs"))


def step_baselines(histogram: DataFrame, days: int = STEP_DAYS) -> DataFrame:
    """step, day, baseline_seconds, baseline_runs: median duration over the `days` days before each day with runs.

    Days' histograms are added up per later day they count for. The median is the smallest duration that at least
    half of the runs do not exceed. A day without earlier runs in the frame has no row.
    """
    judged = histogram.select("step", "day").distinct()
    later = F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", days)))
    spread = histogram.select("step", later.alias("day"), "seconds", "runs")
    # days that nothing is judged on go before the sums
    sums = spread.join(judged, ["step", "day"], "left_semi").groupBy("step", "day", "seconds").agg(F.sum("runs").alias("runs"))
    up_to = Window.partitionBy("step", "day").orderBy("seconds")
    whole = Window.partitionBy("step", "day")
    ranked = sums.withColumns({"below": F.sum("runs").over(up_to), "baseline_runs": F.sum("runs").over(whole)})
    half = ranked.filter(F.col("below") * 2 >= F.col("baseline_runs"))
    return half.groupBy("step", "day").agg(F.min("seconds").alias("baseline_seconds"), F.first("baseline_runs").alias("baseline_runs"))


def slow_runs(log: DataFrame, days: int = STEP_DAYS, slow_pct: float = SLOW_PCT, factor: float = VERY_SLOW_FACTOR) -> DataFrame:
    """D8 with a moving baseline: finished runs much slower than the step's median on earlier days.

    DEGRADED beyond `slow_pct` percent over the baseline, CRITICAL beyond `factor` times. Runs of days without a
    baseline are not judged. Neither a slow run nor others of its day enter its baseline.
    """
    finished = executions(log).filter(F.col("execution_status") != RUNNING).select(
        "execution_id", F.concat_ws("/", "dag_id", "task_id").alias("step"), F.to_date("start_time").alias("day"),
        "execution_duration_seconds",
    )
    usual = checkpointed(step_baselines(step_histogram(log), days).withColumn("key", F.concat_ws("@", "step", "day")))
    usual = usual.select("key", "baseline_seconds", "baseline_runs")
    size = sum(column_bytes(usual).values())
    timed = attach(finished.withColumn("key", F.concat_ws("@", "step", "day")), usual, "key", "inner", size, salt_on="execution_id")
    seconds, baseline = F.col("execution_duration_seconds"), F.col("baseline_seconds")
    rules = [(seconds > factor * baseline, "CRITICAL"), (seconds * 100 > (100 + slow_pct) * baseline, "DEGRADED")]
    return (
        timed.withColumn("alert", first_match(rules, "OK")).filter(F.col("alert") != "OK")
        .select("execution_id", "step", "day", "execution_duration_seconds", "baseline_seconds", "baseline_runs", "alert")
    )
