"""Robust volume checks, moving baselines of steps, snapshots: against brute force."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest

from basketwork import schemas
from basketwork.operators import baselines as b
from basketwork.operators import monitoring, quality
from basketwork.operators.joins import last_before
from basketwork.sources import tables

DAY = dt.date(2024, 1, 1)


def later(n: int) -> dt.date:
    return DAY + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(3)
    rows = [("t", later(i), rng.randrange(90, 110)) for i in range(60) if i % 9 != 4] + [("few", later(i), 5) for i in range(5)]
    rows = [(t, d, 1000 if d == later(41) and t == "t" else n) for t, d, n in rows]
    rows = [(t, d, 10 if d == later(50) and t == "t" else n) for t, d, n in rows]
    return rows, spark.createDataFrame(rows, "table_name string, day date, n long")


def test_volumes_equal_brute_force(history):
    rows, df = history
    got = {(r.table_name, r.day): r for r in b.volume_statistical(df).collect()}
    for table, day, n in rows:
        before = [m for t, d, m in rows if t == table and 1 <= (day - d).days <= 28]
        r = got[table, day]
        assert (r.actual_count, r.history_days) == (n, len(before))
        if len(before) < 7:
            assert r.volume_status == "NO_BASELINE"
            continue
        middle = statistics.median(before)
        mad = statistics.median(abs(m - middle) for m in before)
        reach = max(0.2 * middle, 3 * 1.4826 * mad)
        assert (r.median_count, r.mad) == (middle, mad)
        assert r.volume_status == ("CRITICAL" if n == 0 else "LOW" if n < middle - reach else "HIGH" if n > middle + reach else "NORMAL")
    assert {d: got["t", d].volume_status for d in (later(41), later(42), later(50))} == {later(41): "HIGH", later(42): "NORMAL", later(50): "LOW"}


def test_days_without_rows_are_critical(history):
    rows, df = history
    full = b.every_day(df)
    assert full.filter("table_name = 't'").count() == 60
    got = {r.day: r.volume_status for r in b.volume_statistical(full).filter("table_name = 't'").collect()}
    assert got[later(13)] == "CRITICAL" and got[later(4)] == "NO_BASELINE"


def test_history_of_stored_results(spark):
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    rows = [("x", quality.VOLUME, "NORMAL", at(1, 8), 10.0), ("x", quality.VOLUME, "NORMAL", at(1, 9), 12.0), ("x", "OTHER", "PASS", at(1, 9), 1.0), ("x", quality.VOLUME, "LOW", at(2, 8), 3.0)]
    results = spark.createDataFrame([(*r, 0.0, "", "") for r in rows], schemas.QUALITY_RESULTS)
    assert sorted(map(tuple, b.volume_history(results).collect())) == [("x", dt.date(2024, 1, 1), 12), ("x", dt.date(2024, 1, 2), 3)]


def test_empty_history(spark):
    empty = spark.createDataFrame([], "table_name string, day date, n long")
    assert b.volume_statistical(b.every_day(empty)).isEmpty()


def log_of(spark, runs):
    """An append-only log of finished runs (execution, step, day, seconds)."""
    rows = []
    for name, step, day, seconds in runs:
        start = dt.datetime.combine(later(day), dt.time(3))
        end = start + dt.timedelta(seconds=seconds)
        rows.append((name, "dag", step, "run", "", "", None, "RUNNING", start, None, None, None, False, start))
        rows.append((name, "dag", step, "run", "", "", 1, "SUCCESS", start, end, seconds, "", True, end))
    return spark.createDataFrame(rows, schemas.EXECUTION_LOG)


def test_baselines_equal_brute_force(spark):
    rng = random.Random(5)
    runs = [(f"e{i}", rng.choice("ab"), rng.randrange(40), rng.choice([10, 11, 12, 13, 100])) for i in range(300)]
    log = log_of(spark, runs)
    got = {(r.step, r.day): (r.baseline_seconds, r.baseline_runs) for r in b.step_baselines(b.step_histogram(log), days=7).collect()}
    want, alerts = {}, set()
    for name, step, day, seconds in runs:
        before = sorted(s for _, t, d, s in runs if t == step and 1 <= day - d <= 7)
        if before:
            base = before[(len(before) - 1) // 2]
            want[f"dag/{step}", later(day)] = (base, len(before))
            if seconds > 1.2 * base:
                alerts.add((name, "CRITICAL" if seconds > 5 * base else "DEGRADED"))
    assert got == want
    assert {(r.execution_id, r.alert) for r in b.slow_runs(log, days=7).collect()} == alerts


def test_a_slow_run_does_not_raise_its_own_baseline(spark):
    calm = [(f"e{i}", "s", i, 10) for i in range(10)]
    runs = [*calm, ("slow", "s", 10, 1000), ("also", "s", 10, 1000), ("after", "s", 11, 10)]
    found = {r.execution_id: r for r in b.slow_runs(log_of(spark, runs)).collect()}
    assert set(found) == {"slow", "also"} and found["slow"].baseline_seconds == 10 and found["slow"].alert == "CRITICAL"


def test_histograms_of_parts_add_up(spark):
    runs = [(f"e{i}", "s", i % 3, 10 + i % 4) for i in range(24)]
    whole = b.step_histogram(log_of(spark, runs))
    parts = b.step_histogram(log_of(spark, runs[:11])).unionByName(b.step_histogram(log_of(spark, runs[11:])))
    assert sorted(b.step_baselines(parts).collect()) == sorted(b.step_baselines(whole).collect())


def test_last_before_equals_brute_force(spark):
    rng = random.Random(8)
    taken = sorted({later(rng.randrange(-40, 400)) for _ in range(15)})
    snapshots = spark.createDataFrame([(d, i) for i, d in enumerate(taken)], "taken date, n int")
    days = [later(i) for i in range(0, 420, 3)] + [taken[3], taken[3]]
    got = last_before(spark.createDataFrame([(d,) for d in days], "day date"), "day", snapshots, "taken").collect()
    want = [(d, *max(((t, i) for i, t in enumerate(taken) if t < d), default=(None, None))) for d in days]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    empty = last_before(spark.createDataFrame([(DAY,)], "day date"), "day", snapshots.limit(0), "taken").collect()
    assert [tuple(r) for r in empty] == [(DAY, None, None)]


def test_last_before_is_an_equality_join(spark):
    days = spark.createDataFrame([(DAY,)], "day date")
    plan = last_before(days, "day", spark.createDataFrame([(DAY, 1)], "taken date, n int"), "taken")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_snapshots_are_kept_and_compared(spark, tmp_path):
    counts = spark.createDataFrame([(later(0), 100), (later(5), 105), (later(9), 130)], "day date, product_count long")
    monitoring.take_snapshots(counts.limit(1), str(tmp_path / "s"))
    monitoring.take_snapshots(counts.limit(1).selectExpr("day", "product_count + 1 AS product_count"), str(tmp_path / "s"))
    monitoring.take_snapshots(counts.filter("product_count = 105"), str(tmp_path / "s"))
    got = {r.product_count: (r.previous_count, r.status) for r in monitoring.change_since_snapshot(counts, tables.stored(spark, str(tmp_path / "s"))).collect()}
    assert got == {100: (None, "NO_SNAPSHOT"), 105: (100, "NORMAL"), 130: (105, "ANOMALY")}
