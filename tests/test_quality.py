from __future__ import annotations

import datetime as dt

import pytest
from conftest import AS_OF, rows_by

from basketwork import schemas
from basketwork.operators import quality, validation
from basketwork.operators.warehouse import Warehouse

NOW = dt.datetime(2024, 6, 30, 12)


@pytest.fixture(scope="module")
def good(warehouse):
    customers = [{"customer_id": i, "email": f"{i}@x.io"} for i in "ab"]
    return warehouse(customers, [{"product_id": "p"}], [{"campaign_id": "m"}],
                     [{"customer_id": "a", "campaign_id": "m"} for _ in range(3)])


def test_unique_warehouse_passes_in_one_row(good):
    (row,) = quality.uniqueness(quality.unique_keys(good), NOW).collect()
    assert (row.table_name, row.violation_count, row.total_duplicates, row.check_status) == ("ALL_TABLES", 0, 0, "PASS")


def test_duplicates_fail_and_null_emails_do_not_count(spark, good):
    keys = spark.createDataFrame([("x",), ("x",), ("y",), ("y",), ("y",), ("z",)], "customer_id string")
    emails = spark.createDataFrame([(None,), (None,), ("e",)], "email string").filter("email is not null")
    out = quality.uniqueness({"dim_customers": (keys, "customer_id"), "mail": (emails, "email")}, NOW).collect()
    assert [(r.table_name, r.violation_count, r.total_duplicates, r.check_status) for r in out] == [
        ("dim_customers", 2, 5, "FAIL")
    ]


def profiles(spark, rows):
    return spark.createDataFrame(
        rows, "table_name string, total_records bigint, filled_cells bigint, critical_columns int, latest timestamp, oldest timestamp"
    )


def test_completeness_levels(spark):
    cells = {"full": 50000, "94.99": 47495, "95": 47500, "90": 45000, "89.99": 44995}
    rows = [(k, 10000, v, 5, None, None) for k, v in cells.items()] + [("empty", 0, 0, 5, None, None)]
    out = rows_by(quality.completeness(profiles(spark, rows), NOW), "table_name")
    assert {k: v.check_status for k, v in out.items()} == {
        "full": "PASS", "94.99": "WARNING", "95": "PASS", "90": "WARNING", "89.99": "FAIL", "empty": "FAIL",
    }
    assert out["empty"].overall_completeness_pct is None


def test_freshness_levels(spark):
    hours = [24, 25, 48, 49, 168, 169]
    rows = [(str(h), 1, 5, 5, NOW - dt.timedelta(hours=h, minutes=59), NOW - dt.timedelta(days=30)) for h in hours]
    rows.append(("empty", 0, 0, 5, None, None))
    out = rows_by(quality.freshness(profiles(spark, rows), NOW), "table_name")
    assert [out[str(h)].freshness_status for h in hours] == ["FRESH", "ACCEPTABLE", "ACCEPTABLE", "AGING", "AGING", "STALE"]
    assert [out[str(h)].hours_since_latest for h in hours] == hours
    assert out["empty"].freshness_status == "STALE"


def test_day_spans_count_dates_or_whole_days(spark):
    late, early = dt.datetime(2024, 6, 30, 1), dt.datetime(2024, 6, 28, 23)
    rows = [(n, 1, 5, 5, late, early) for n in ("dim_customers", "dim_campaigns")]
    out = rows_by(quality.freshness(profiles(spark, rows), NOW), "table_name")
    assert out["dim_customers"].data_age_span_days == 2 and out["dim_campaigns"].data_age_span_days == 1


def test_volume_classes(spark):
    expected = {str(n): (5, 10) for n in (0, 4, 5, 10, 11)}
    rows = [(k, int(k), 0, 5, None, None) for k in expected]
    out = quality.volume(profiles(spark, rows), NOW, expected).collect()
    assert {r.table_name: r.volume_status for r in out} == {"0": "CRITICAL", "4": "LOW", "5": "NORMAL", "10": "NORMAL", "11": "HIGH"}
    assert [r.table_name for r in out] == ["0", "4", "11", "10", "5"]
    assert out[0].recommended_action == "Check data ingestion pipeline"


def fact_with_orphans(spark, good, n, orphans):
    from pyspark.sql import functions as F

    key = F.when(F.col("id") < orphans, "nobody").otherwise("a")
    sales = spark.range(n).select(key.alias("customer_id"), F.lit("p").alias("product_id"), F.lit("m").alias("campaign_id"))
    return Warehouse(good.customers, good.products, good.campaigns, sales)


def test_foreign_key_levels(spark, good):
    for orphans, status in ((0, "PASS"), (500, "WARNING"), (501, "FAIL")):
        w = fact_with_orphans(spark, good, 10000, orphans)
        row = rows_by(quality.integrity(w, NOW), "relationship_name")["fact_transactions_to_dim_customers"]
        assert (row.total_records, row.orphaned_records, row.check_status) == (10000, orphans, status)


def test_utilisation_counts_joined_rows(good):
    row = rows_by(quality.integrity(good, NOW), "relationship_name")["dim_customers_orphaned"]
    assert (row.total_records, row.orphaned_records, row.percentage, row.check_status) == (4, 1, 75.0, "GOOD")
    row = rows_by(quality.integrity(good, NOW, per_dimension=True), "relationship_name")["dim_customers_orphaned"]
    assert (row.total_records, row.orphaned_records, row.percentage, row.check_status) == (2, 1, 50.0, "GOOD")
    assert row.status_description == "Good dimension utilization"
    used = rows_by(quality.integrity(good, NOW), "relationship_name")["dim_products_orphaned"]
    assert used.check_status == "OPTIMAL"


def test_empty_tables_give_no_percentage(warehouse):
    empty = warehouse([{"customer_id": None}], [{"product_id": None}], [{"campaign_id": None}], [])
    out = rows_by(quality.integrity(empty, NOW), "relationship_name")
    fk = out["fact_transactions_to_dim_customers"]
    assert fk.total_records == 0 and fk.percentage is None and fk.check_status == "FAIL"


def test_results_and_health(good):
    results = quality.run_all(good, NOW)
    assert results.columns == [f.name for f in schemas.QUALITY_RESULTS.fields]
    kinds = {r.check_type for r in results.collect()}
    assert len(kinds) == 6
    # two customers are fewer than expected, but low volume is no failure
    assert quality.system_health(results, NOW.date()).first().system_health == "HEALTHY"
    assert quality.system_health(results, AS_OF - dt.timedelta(days=1)).first().system_health == "HEALTHY"


@pytest.mark.parametrize("status", ["FAIL", "CRITICAL"])
def test_one_bad_status_is_unhealthy(spark, status):
    rows = [("t", "A", "PASS", NOW, 1.0, 1.0, None, None), ("t", "B", status, NOW, 1.0, 1.0, None, None)]
    results = spark.createDataFrame(rows, schemas.QUALITY_RESULTS)
    out = quality.health(results, NOW.date()).collect()
    assert {r.system_health for r in out} == {"UNHEALTHY"} and len(out) == 2


def test_campaign_key_counts_no_campaign_as_valid(warehouse):
    w = warehouse([{"customer_id": "c"}], [{"product_id": "p"}], [{"campaign_id": "m"}],
                  [{"campaign_id": c} for c in (None, "", "m", "lost")])
    row = validation.campaign_key(w).first()
    assert (row.total_transactions, row.valid_campaign_refs, row.no_campaign_count) == (4, 2, 1)
    assert rows_by(validation.orphans(w), "issue")["orphaned_campaigns"]["count"] == 2


def test_schema_listing(spark, good):
    out = validation.schema_listing(spark, good.tables).collect()
    sizes = {name: sum(r.table_name == name for r in out) for name in good.tables}
    assert sizes == {"dim_customers": 14, "dim_products": 19, "dim_campaigns": 22, "fact_sales_transactions": 22}


def test_gates(spark, good, tmp_path):
    assert validation.require_rows(good.tables)["dim_customers"] == 2
    with pytest.raises(validation.GateError):
        validation.require_rows({n: df.limit(0) for n, df in good.tables.items()})
    with pytest.raises(validation.GateError, match="absent"):
        validation.require_folders(spark, [str(tmp_path / "absent")])
