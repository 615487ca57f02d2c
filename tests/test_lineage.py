from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows_by
from pyspark.sql import functions as F

from basketwork import schemas
from basketwork.operators import lineage, monitoring

NOW = dt.datetime(2024, 6, 30, 12)


@pytest.fixture(scope="module")
def registry(spark):
    return lineage.seed(spark, NOW)


def test_seed_reports(registry):
    assert registry.sources.columns == [f.name for f in schemas.LINEAGE_SOURCES.fields]
    assert lineage.complete_lineage(registry).count() == 4
    assert lineage.field_lineage(registry).count() == 4
    impact = rows_by(lineage.quality_impact(registry), "target_name")
    assert len(impact) == 8
    assert impact["Sales Fact Table"].filtering_transformations == 1
    assert impact["Sales Fact Table"].quality_rating == "MEDIUM_CONFIDENCE"
    assert impact["Product Dimension"].quality_rating == "HIGH_CONFIDENCE"
    dependencies = lineage.pipeline_dependencies(registry).collect()
    assert len(dependencies) == 4 and {r.complexity_level for r in dependencies} == {"SIMPLE"}
    counts = {r["category"]: r["count"] for r in lineage.summary(registry).collect()}
    assert counts == {"SOURCES": 4, "TARGETS": 8, "TRANSFORMATIONS": 24, "RELATIONSHIPS": 8}


def test_two_hop_lineage_keeps_warehouse_edges(registry):
    assert lineage.complete_lineage(registry.with_targets_as_sources()).count() == 8


def test_inactive_relationships_drop_out(registry):
    off = registry.relationships.withColumn("is_active", F.col("relationship_id") != "REL_001")
    partial = lineage.Lineage(registry.sources, registry.targets, registry.transformations, off)
    assert lineage.complete_lineage(partial).count() == 3
    assert {r["category"]: r["count"] for r in lineage.summary(partial).collect()}["RELATIONSHIPS"] == 7


def test_views(spark, registry):
    lineage.register_views(registry)
    assert spark.sql("select count(*) from v_lineage_quality_impact").first()[0] == 8
    assert lineage.edges(registry, 2).count() == 2


class Clock:
    def __init__(self):
        self.now = NOW

    def __call__(self):
        self.now += dt.timedelta(seconds=10)
        return self.now


def test_tracker_logs_success_failure_and_running(spark, tmp_path):
    tracker = lineage.Tracker(spark, str(tmp_path / "lineage"), "run1", Clock())
    with tracker.step("dag", "good", "a", "b") as step:
        step.records = 7
    with pytest.raises(ValueError):
        with tracker.step("dag", "bad"):
            raise ValueError("broken")
    name = tracker.capture(step, "pipe", "SRC_CSV_CUSTOMERS", "TGT_STAGING_CUSTOMERS", "TRANS_CUST_001")
    assert name.startswith("RT_dag_good_") and tracker.errors == []
    log = spark.read.parquet(str(tmp_path / "lineage/execution_log"))
    assert log.columns == [f.name for f in schemas.EXECUTION_LOG.fields] and log.count() == 4
    state = rows_by(lineage.executions(log), "task_id")
    assert (state["good"].execution_status, state["good"].records_processed) == ("SUCCESS", 7)
    assert (state["bad"].execution_status, state["bad"].error_message) == ("FAILED", "broken")
    assert state["good"].execution_duration_seconds > 0 and state["good"].lineage_captured
    started = rows_by(lineage.executions(log.filter("execution_status = 'RUNNING'")), "task_id")
    assert started["good"].execution_status == "RUNNING" and started["good"].end_time is None
    captured = spark.read.parquet(str(tmp_path / "lineage/relationships")).first()
    assert captured.relationship_id == name and captured.is_active


def test_log_errors_do_not_stop_a_step(spark):
    tracker = lineage.Tracker(spark, "/proc/not/writable", "run1", Clock())
    with tracker.step("dag", "task") as step:
        step.records = 1
    assert len(tracker.errors) == 2


def test_slow_steps(spark):
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i, seconds in enumerate([10] * 20 + [14, 200]):
        end = start + dt.timedelta(seconds=seconds)
        rows.append((f"e{i}", "dag", "task", "r", None, None, 1, "SUCCESS", start, end, seconds, "", True, end))
    out = rows_by(monitoring.slow_steps(spark.createDataFrame(rows, schemas.EXECUTION_LOG)), "execution_id")
    assert set(out) == {"e21"} and out["e21"].alert == "CRITICAL"
