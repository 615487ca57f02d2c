from __future__ import annotations

import datetime as dt
import os
from types import SimpleNamespace

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from basketwork import schemas
from basketwork.operators import lineage, monitoring, validation
from basketwork.plans import landing, pipeline, warehouse
from basketwork.session import shared_dir
from basketwork.sources import contracts, sample_feeds
from basketwork.streaming import transactions as stream

AT = dt.datetime(2001, 11, 5, 8)

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="sample tables not present")


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The sample drops, with sales of two months, to keep the number of day folders small."""
    raw = landing.land(spark, str(DATA), str(tmp_path_factory.mktemp("landed")))
    months = spark.read.text(raw["sales_transactions"]).filter(F.col("value").rlike('"transaction_date":"1999-0[34]'))
    months.write.text(few := str(tmp_path_factory.mktemp("landed") / "sales"))
    return {**raw, "sales_transactions": few}


@pytest.fixture(scope="module")
def finished(spark, landed, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("run"))
    return root, pipeline.run(spark, root, landed, sample_feeds.AS_OF, AT)


def test_run_reports_counts_and_health(spark, finished):
    root, run = finished
    assert run.staging_counts["products"] == sample_feeds.products(spark, str(DATA)).count()
    assert run.warehouse_counts["fact_sales_transactions"] > 0
    assert run.health == "UNHEALTHY"  # half of the sales have no campaign
    assert run.log_errors == [] and run.duration_seconds > 0


def test_run_leaves_lineage_and_results(spark, finished):
    layout = pipeline.Layout(finished[0])
    registry = pipeline.lineage_of(spark, layout, AT)
    counts = {r["category"]: r["count"] for r in lineage.summary(registry).collect()}
    assert counts["RELATIONSHIPS"] == 8 + 8
    states = lineage.executions(spark.read.parquet(f"{layout.lineage}/execution_log")).collect()
    assert len(states) == 6 and {r.execution_status for r in states} == {"SUCCESS"}
    assert spark.read.parquet(layout.events).count() == 4
    assert spark.read.parquet(layout.quality).count() > 15


def test_warehouse_invariants(spark, finished):
    w = warehouse.load(spark, f"{finished[0]}/warehouse")
    assert {r.uniqueness_check for r in validation.key_uniqueness(w).collect()} == {"PASS"}
    assert {r.integrity_pct for r in validation.customer_and_product_keys(w).collect()} == {100.0}
    listing = {r.table_name: r for r in validation.table_listing(spark, f"{finished[0]}/warehouse").collect()}
    assert listing["dim_products"].size_bytes > 0 and listing["dim_products"].row_count == w.products.count()


def test_customers_delivered_twice_do_not_change_the_dimension(spark, landed, finished):
    root, first = finished
    layout = pipeline.Layout(root)
    records = pipeline.ingest(spark, layout, landed, "customers", AT + dt.timedelta(hours=1), None)
    staged = pipeline.staging(spark, layout)
    assert staged["customers"].count() == 2 * records
    again = warehouse.build(staged, f"{root}/again", sample_feeds.AS_OF)
    assert again.customers.count() == first.warehouse_counts["dim_customers"]


def test_missing_staging_stops_the_transform(spark, tmp_path):
    with pytest.raises(validation.GateError):
        pipeline.transform(spark, pipeline.Layout(str(tmp_path)), sample_feeds.AS_OF, AT)


def test_run_appends_its_figures(spark, finished):
    root, run = finished
    (row,) = spark.read.schema(schemas.PIPELINE_RUNS).parquet(pipeline.Layout(root).runs).collect()
    assert (row.run_id, row.started, row.health, row.log_errors) == ("run_20011105_080000", AT, run.health, 0)
    assert row.staging_records == sum(run.staging_counts.values()) and row.warehouse_records == sum(run.warehouse_counts.values())
    assert row.duration_seconds == run.duration_seconds > 0


def test_local_folders_are_no_shared_folders():
    from basketwork.session import is_shared

    assert is_shared("/w", "local[4]") and is_shared("file:/w", "local-cluster[2,1,1024]") and is_shared("hdfs://n/w", "yarn") and is_shared("s3a://b/w", "k8s://x")
    assert not is_shared("/w", "yarn") and not is_shared("file:/w", "spark://host:7077")


def test_unreadable_results_are_unknown(spark, tmp_path):
    assert pipeline.day_health(spark, pipeline.Layout(str(tmp_path)), AT.date()) == "UNKNOWN"


def test_cap_and_unhealthy_stop(spark, landed, tmp_path):
    with pytest.raises(validation.GateError, match="UNHEALTHY"):
        pipeline.run(spark, str(tmp_path), landed, sample_feeds.AS_OF, AT, cap=100, raise_when_unhealthy=True)
    assert spark.read.parquet(f"{tmp_path}/staging/sales_transactions").count() <= 300


def test_rebuild_drops_days_and_keeps_hot_and_odd_ones(spark, tmp_path):
    feeds = sample_feeds.all_feeds(spark, str(DATA))
    # one month of feed rows, to keep the number of folders small
    feeds["sales_transactions"] = feeds["sales_transactions"].filter("transaction_date >= '1999-03-01' and transaction_date < '1999-04-01'")
    path = str(tmp_path / "w")
    whole = warehouse.build(feeds, path, sample_feeds.AS_OF).sales.agg(F.count("*"), F.countDistinct("transaction_date")).first()
    fewer = {**feeds, "sales_transactions": feeds["sales_transactions"].filter("transaction_date < '1999-03-11'")}
    again = warehouse.build(fewer, path, sample_feeds.AS_OF).sales
    rows, days = again.agg(F.count("*"), F.countDistinct("transaction_date")).first()
    assert 0 < rows < whole[0] and days < whole[1] and again.filter("transaction_date >= '1999-03-12'").isEmpty()
    # a year-1 date changes nothing in the layout
    odd = feeds["sales_transactions"].limit(1).withColumns({"transaction_date": F.to_timestamp(F.lit("0001-01-01")), "transaction_id": F.lit("odd")})
    fewer["sales_transactions"] = fewer["sales_transactions"].unionByName(odd)
    warehouse.build(fewer, path, sample_feeds.AS_OF)
    assert all(p.startswith(("transaction_date=", ".", "_")) for p in os.listdir(f"{path}/fact_sales_transactions"))


def test_stream_loads_each_sale_once(spark, feed, tmp_path):
    sales = feed("sales_transactions", *[{"transaction_id": str(i % 5), "campaign_id": None} for i in range(20)],
                 {"transaction_id": "x", "status": "refunded"})
    source, staging, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    sales.repartition(4).write.json(source)

    def load():
        rows = stream.first_deliveries(stream.read_stream(spark, source, files_per_batch=1))
        stream.load_stream(rows, staging, state).awaitTermination()

    load()
    assert spark.read.parquet(staging).count() == 5
    # later files: two repeats within the limit and one new sale
    feed("sales_transactions", *[{"transaction_id": i} for i in ("0", "1", "new")]).write.mode("append").json(source)
    load()
    out = spark.read.parquet(staging)
    assert out.count() == 6 and {r.campaign_id for r in out.collect()} == {""}
    assert set(f.name for f in schemas.METADATA["sales_transactions"].fields) <= set(out.columns)
    assert stream.staleness(out).first().within_limit
    assert not stream.staleness(out.limit(0)).first().within_limit


def test_quarantine_splits_all_rows(spark, finished, tmp_path):
    sales = warehouse.load(spark, f"{finished[0]}/warehouse").sales
    monitoring.quarantine(sales, str(tmp_path / "all"))
    rows = spark.read.parquet(str(tmp_path / "all"))
    good, bad = rows.filter("verdict = 'good'"), rows.filter("verdict = 'bad'")
    assert good.count() + bad.count() == sales.count() and bad.filter("reasons = ''").isEmpty()


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def session_with(**conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)))


def test_the_shared_folder_is_never_a_temporary_one():
    checkpoints, below = "spark.checkpoint.dir", "spark.sql.warehouse.dir"
    assert shared_dir(session_with(**{checkpoints: "hdfs:///shared/", below: "x"})) == "hdfs:///shared"
    assert shared_dir(session_with(**{below: "hdfs:///warehouse"})) == "hdfs:///warehouse/shared"


def _rewritten(spark, path, tmp_path, change):
    """The JSON lines of a drop after `change`, in a new folder."""
    out = str(tmp_path / "changed")
    change(spark.read.text(path)).write.text(out)
    return out


@pytest.mark.parametrize("feed, key", [("products", "price"), ("marketing_campaigns", "budget"), ("sales_transactions", "amount")])
def test_an_absent_key_raises_or_warns(spark, landed, tmp_path, caplog, feed, key):
    path = _rewritten(spark, landed[feed], tmp_path, lambda t: t.withColumn("value", F.regexp_replace("value", f'"{key}":', f'"no_{key}":')))
    layout = pipeline.Layout(str(tmp_path / "run"))
    if pipeline.ON_VIOLATION[feed] == "raise":
        with pytest.raises(contracts.ContractError, match=key):
            pipeline.ingest(spark, layout, {**landed, feed: path}, feed, AT, None)
        assert not os.path.exists(f"{layout.staging}/{feed}")
    else:
        pipeline.ingest(spark, layout, {**landed, feed: path}, feed, AT, None)
        assert f"records lack {key}" in caplog.text


@pytest.mark.parametrize("feed", ["products", "marketing_campaigns", "sales_transactions"])
def test_an_empty_feed_is_not_valid(spark, landed, tmp_path, caplog, feed):
    path = _rewritten(spark, landed[feed], tmp_path, lambda t: t.limit(0))
    layout, raw = pipeline.Layout(str(tmp_path / "run")), {**landed, feed: path}
    if pipeline.ON_VIOLATION[feed] == "raise":
        with pytest.raises(contracts.ContractError, match="no records"):
            pipeline.ingest(spark, layout, raw, feed, AT, None)
    else:
        pipeline.ingest(spark, layout, raw, feed, AT, None)
        assert "no records" in caplog.text


def test_rejected_lines_are_kept_and_counted(spark, landed, tmp_path):
    torn = '{"campaign_id": "torn", "name": "x'
    path = _rewritten(spark, landed["marketing_campaigns"], tmp_path, lambda t: t.union(spark.createDataFrame([(torn,)], "value string")))
    layout = pipeline.Layout(str(tmp_path / "run"))
    pipeline.ingest(spark, layout, {**landed, "marketing_campaigns": path}, "marketing_campaigns", AT, None)
    assert [r.value for r in spark.read.text(f"{layout.lake}/rejected/marketing_campaigns").collect()] == [torn]
    assert spark.read.parquet(layout.events).first().error == "1 records rejected"
    assert spark.read.parquet(f"{layout.staging}/marketing_campaigns").filter("campaign_id = 'torn' OR campaign_id IS NULL").isEmpty()
