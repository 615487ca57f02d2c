"""The plans the jobs are meant to get."""

from __future__ import annotations

import re

import pytest
from conftest import AS_OF, DATA
from pyspark.sql import functions as F

from basketwork.operators import analytics, star, validation
from basketwork.plans.warehouse import sample_warehouse
from basketwork.sources import sample_feeds

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="sample tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def w(spark):
    return sample_warehouse(spark, str(DATA))


@pytest.fixture(scope="module")
def reports(w):
    return {
        "a1": analytics.customer_lifetime_value(w, AS_OF),
        "a2": analytics.customer_segmentation(w, AS_OF),
        "a4": analytics.campaign_roi(w),
        "a7": analytics.inventory_analysis(w, AS_OF),
        "a9": analytics.cohort_analysis(w),
        "a11": analytics.attribution_matrix(w),
        "v13": validation.multi_dimensional(w, AS_OF),
        "fact": star.fact_sales(sample_feeds.transactions(w.sales.sparkSession, str(DATA)), w.customers, w.products),
    }


def test_no_python_and_no_cross_joins(reports):
    for name, df in reports.items():
        text = plan(df)
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
            assert word not in text, f"{name}: {word}"


def test_dedupe_keeps_one_row_per_key_before_the_shuffle(reports):
    text = plan(reports["fact"])
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_customer_reports_combine_sales_before_the_join(reports):
    for name in ("a1", "a2", "a7"):
        text = plan(reports[name])
        join = re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", text).start()
        combine = text.index("partial_sum(amount")
        assert join < combine < text.index("FileScan parquet", combine)


def test_scans_read_only_needed_columns(reports):
    schema = re.search(r"ReadSchema: struct<(customer_id:string,amount[^>]*)>", plan(reports["a1"]))
    assert schema and "payment_method" not in schema.group(1)


def test_date_limits_reach_the_scan(reports):
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(transaction_date", plan(reports["v13"]))


def test_top_k_does_not_sort_everything(reports):
    for name in ("a1", "a7", "a11", "v13"):
        assert "TakeOrderedAndProject" in plan(reports[name])


def test_day_folders_are_pruned(spark, w, tmp_path):
    from basketwork.sources.tables import stored, write_fact

    path = str(tmp_path / "fact")
    write_fact(w.sales.filter("transaction_date between '1999-03-01' and '1999-03-05'"), path)
    text = plan(stored(spark, path).filter(F.col("transaction_date") == F.lit("1999-03-02").cast("date")))
    assert re.search(r"PartitionFilters: \[[^]]*transaction_date", text)
