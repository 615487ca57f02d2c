"""Every query by name: `(spark, sf_dir) -> DataFrame` on the sample tables.

Queries read the stored sample warehouse or the sample feeds. Load timestamps
are left out of results, since they differ from run to run.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketwork import schemas
from basketwork.operators import analytics, lineage, monitoring, quality, star, validation
from basketwork.plans import pipeline
from basketwork.plans.features import FEATURES
from basketwork.plans import warehouse as warehouses
from basketwork.plans.landing import landed_feeds
from basketwork.plans.warehouse import sample_path, sample_warehouse
from basketwork.session import shared_dir
from basketwork.sources import contracts, documents, lake, sample_feeds, tables
from basketwork.sources.sample_feeds import AS_OF
from basketwork.streaming import fact as fact_stream
from basketwork.streaming import transactions as stream

Query = Callable[[SparkSession, str], DataFrame]
_LOADED = ("created_date", "last_updated_date", "created_timestamp")
NOW = dt.datetime.combine(AS_OF, dt.time(12))
# the sample tables end in 2001, so reports since 2024 would be empty
SINCE = dt.date(1998, 1, 1)
# the columns whose newest value stands for the load time of each table
TIMES = {
    "dim_customers": "registration_date",
    "dim_products": "created_date",
    "dim_campaigns": "start_date",
    "fact_sales_transactions": "transaction_date",
}


def _show(df: DataFrame, *dropped: str) -> DataFrame:
    """Drop load timestamps; decimals as doubles, timestamps without zone."""
    shown = {"decimal": "double", "timestamp": "timestamp_ntz"}
    return df.select(
        *[
            F.col(name).cast(shown[kind.split("(")[0]]).alias(name) if kind.split("(")[0] in shown else F.col(name)
            for name, kind in df.dtypes
            if name not in dropped + _LOADED
        ]
    )


def _on_warehouse(build: Callable) -> Query:
    return lambda spark, sf_dir: build(sample_warehouse(spark, sf_dir))


def _fk_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = sample_warehouse(spark, sf_dir)
    keys, sales = ["transaction_id", "customer_id", "product_id", "campaign_id"], sample_feeds.transactions(spark, sf_dir, with_order=True)
    flags = star.fk_flags(sales, w.customers, w.products, w.campaigns, columns=keys, within=[sample_feeds.ORDER])
    return flags.select("transaction_id", "customer_exists", "product_exists", "campaign_exists")


STAR: dict[str, Query] = {
    "t1_dim_customers": lambda spark, d: _show(star.dim_customers(sample_feeds.customers(spark, d))),
    "t2_dim_products": lambda spark, d: _show(star.dim_products(sample_feeds.products(spark, d))),
    "t3_dim_campaigns": lambda spark, d: _show(star.dim_campaigns(sample_feeds.campaigns(spark, d), AS_OF)),
    "t4_fact_sales": _on_warehouse(lambda w: _show(w.sales)),
    "t4_fk_flags": _fk_flags,
}

ANALYTICS: dict[str, Query] = {
    "a1_clv": _on_warehouse(lambda w: analytics.customer_lifetime_value(w, AS_OF)),
    "a2_segmentation": _on_warehouse(lambda w: analytics.customer_segmentation(w, AS_OF)),
    "a3_geography": _on_warehouse(lambda w: analytics.geographic_performance(w, AS_OF)),
    "a4_campaign_roi": _on_warehouse(analytics.campaign_roi),
    "a5_channels": _on_warehouse(analytics.channel_performance),
    "a6_products": _on_warehouse(analytics.product_performance),
    "a7_inventory": _on_warehouse(lambda w: analytics.inventory_analysis(w, AS_OF)),
    "a8_seasonal": _on_warehouse(analytics.seasonal_analysis),
    "a9_cohorts": _on_warehouse(analytics.cohort_analysis),
    "a10_executive": _on_warehouse(lambda w: analytics.executive_summary(w, AS_OF)),
    "a11_attribution": _on_warehouse(analytics.attribution_matrix),
}



def _check(build: Callable) -> Query:
    """A quality check without its time of checking."""
    return _on_warehouse(lambda w: _show(build(w), "check_timestamp"))


def _raw_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = sample_feeds.all_feeds(spark, sf_dir)
    keys = ("customer_id", "product_id", "campaign_id", "transaction_id")
    keyed = {name: (df, key) for (name, df), key in zip(feeds.items(), keys)}
    emails = feeds["customers"].filter(F.col("email").isNotNull())
    return _show(quality.uniqueness({**keyed, "customers_email": (emails, "email")}, NOW), "check_timestamp")


def _primary_keys(w) -> dict:
    return {name: pair for name, pair in quality.unique_keys(w).items() if name != quality.EMAIL_CHECK}


def _of_type(check_type: str, per_dimension: bool = False) -> Callable:
    return lambda w: quality.integrity(w, NOW, per_dimension).filter(F.col("check_type") == check_type)


_stored_results: dict[tuple[str, int], str] = {}


def _results(w) -> DataFrame:
    """Check results of a warehouse, run and stored once per application, then read."""
    spark = w.sales.sparkSession
    key = (spark.sparkContext.applicationId, id(w))
    if key not in _stored_results:
        path = f"{_fresh_folder(spark)}/quality"
        quality.run_all(w, NOW, TIMES).write.parquet(path)
        _stored_results[key] = path
    return tables.stored(spark, _stored_results[key], schemas.QUALITY_RESULTS)


QUALITY: dict[str, Query] = {
    "q1_uniqueness": _raw_uniqueness,
    "q1_uniqueness_clean": _check(lambda w: quality.uniqueness(_primary_keys(w), NOW)),
    "q1_uniqueness_warehouse": _check(lambda w: quality.uniqueness(quality.unique_keys(w), NOW)),
    "q2_completeness": _check(lambda w: quality.completeness(quality.profile(w), NOW)),
    "q3_fk_integrity": _check(_of_type(quality.FOREIGN_KEYS)),
    "q4_dim_utilisation": _check(_of_type(quality.UTILISATION)),
    "q4_dim_utilisation_per_dimension": _on_warehouse(
        lambda w: _of_type(quality.UTILISATION, True)(w).select(
            "relationship_name", "total_records", "orphaned_records", "percentage"
        )
    ),
    "q5_integrity_report": _check(lambda w: quality.integrity(w, NOW)),
    "q6_freshness": _check(lambda w: quality.freshness(quality.profile(w, times=TIMES), NOW)),
    "q7_volume": _check(lambda w: quality.volume(quality.profile(w), NOW)),
    "q8_results": _on_warehouse(lambda w: _show(_results(w))),
    "q9_health": _on_warehouse(lambda w: quality.health(_results(w), AS_OF)),
    "m1_latest": _on_warehouse(lambda w: _show(quality.latest_results(_results(w)))),
    "m4_patterns": _on_warehouse(lambda w: quality.result_patterns(_results(w))),
}


def _gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = sample_warehouse(spark, sf_dir)
    return validation.table_counts({**sample_feeds.all_feeds(spark, sf_dir), **w.tables})


VALIDATION: dict[str, Query] = {
    "v1_tables": lambda spark, d: validation.table_listing(spark, sample_path(spark, d)),
    "v2_counts": _on_warehouse(lambda w: validation.table_counts(w.tables)),
    "v4_v5_fk": _on_warehouse(validation.customer_and_product_keys),
    "v6_campaign_fk": _on_warehouse(validation.campaign_key),
    "v7_orphans": _on_warehouse(validation.orphans),
    "v8_keys": _on_warehouse(validation.key_uniqueness),
    "v9_completeness": _on_warehouse(validation.field_completeness),
    "v10_nulls": _on_warehouse(validation.required_nulls),
    "v11_dates": _on_warehouse(lambda w: validation.date_range(w, AS_OF, SINCE)),
    "v12_country": _on_warehouse(validation.revenue_by_country),
    "v13_multi": _on_warehouse(lambda w: validation.multi_dimensional(w, SINCE)),
    "v14_monthly": _on_warehouse(lambda w: validation.monthly_revenue(w, SINCE)),
    "v15_summary": _on_warehouse(lambda w: _show(validation.summary(w, NOW))),
    "v16_country_kpi": _on_warehouse(validation.country_kpis),
    "v17_category": _on_warehouse(validation.category_revenue),
    "g2_g4_gates": _gates,
}


def _on_history(build: Callable) -> Query:
    """A lineage report over the captured run history of the sample events."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        registry = lineage.seed(spark, NOW)
        captures = sample_feeds.captured_relationships(spark, sf_dir)
        return _show(
            build(lineage.Lineage(registry.sources, registry.targets, registry.transformations, captures))
        )

    return query


def _on_log(build: Callable) -> Query:
    return lambda spark, d: _show(build(sample_feeds.execution_log(spark, d)))


LINEAGE: dict[str, Query] = {
    "l7_complete": _on_history(lineage.complete_lineage),
    "l8_field": _on_history(lineage.field_lineage),
    "l9_impact": _on_history(lineage.quality_impact),
    "l10_dependencies": _on_history(lineage.pipeline_dependencies),
    "l11_summary": _on_history(lineage.summary),
    "l12_executions": _on_log(lineage.executions),
    "l13_edges": _on_history(lambda registry: registry.active()),
    "l14_running_times": _on_log(lineage.running_times),
    "l13_l14_tracked_feeds": lambda spark, d: _tracked_feeds(spark, d),
    "m2_edges": _on_history(lineage.edges),
    "m3_runs": _on_log(lineage.latest_executions),
}



def _tracked_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count each feed in a tracked step, capture its relationship, and read log and captures."""
    folder = _fresh_folder(spark)
    tracker = lineage.Tracker(spark, folder, run_id="tracked")
    for feed, df in sample_feeds.all_feeds(spark, sf_dir).items():
        with tracker.step(*pipeline.STEPS[feed], source_table=feed, target_table="staging_area") as step:
            step.records = df.count()
        pipeline.capture_of(tracker, step, feed)
    steps = lineage.executions(tables.stored(spark, f"{folder}/execution_log", schemas.EXECUTION_LOG))
    captured = tables.stored(spark, f"{folder}/relationships", schemas.LINEAGE_RELATIONSHIPS)
    per_step = captured.filter("is_active").groupBy("dag_id", "task_id").agg(F.count_distinct("relationship_id").alias("captures"))
    return steps.join(per_step, ["dag_id", "task_id"]).select(
        "source_table", "execution_status", "records_processed", "lineage_captured", "captures"
    )


def _fresh_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def _on_raw(build: Callable) -> Query:
    """A query over the landed raw drops."""
    return lambda spark, d: _show(build(spark, landed_feeds(spark, d)))


def _customer_rows(spark: SparkSession, raw: dict) -> DataFrame:
    return lake.read_latest_customers(spark, f"{raw['root']}/raw")


def _contract_report(spark: SparkSession, raw: dict) -> DataFrame:
    report = contracts.column_report(_customer_rows(spark, raw), schemas.REQUIRED["customers"])
    joined = {name: F.array_join(name, ",") for name in ("missing_columns", "extra_columns")}
    return report.withColumns(joined)


def _campaign_documents(spark: SparkSession, raw: dict) -> DataFrame:
    docs = documents.read_documents(spark, raw["marketing_campaigns"], "marketing_campaigns")
    shown = docs.drop("document_id", "created_date", "updated_date")
    return lake.iso_timestamps(documents.campaign_documents(docs).select(shown.columns))


def _sale_documents(spark: SparkSession, raw: dict, cap: int | None) -> DataFrame:
    docs = documents.read_documents(spark, raw["sales_transactions"], "sales_transactions")
    newest = documents.newest_first(documents.sale_documents(docs, cap))
    return documents.fill_campaign(newest).drop("document_id", "updated_date")


def _all_sale_documents(spark: SparkSession, raw: dict) -> DataFrame:
    docs = documents.read_documents(spark, raw["sales_transactions"], "sales_transactions")
    return docs.drop("document_id", "updated_date")


def _staging_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load two feeds twice: customers are appended, products replaced."""
    folder, counts = _fresh_folder(spark), []
    feeds = sample_feeds.all_feeds(spark, sf_dir)
    for feed in ("customers", "products"):
        mode = pipeline.STAGING_MODES[feed]
        for _ in range(2):
            tables.write_staging(feeds[feed], f"{folder}/{feed}", mode)
        n = tables.stored(spark, f"{folder}/{feed}").agg(F.count(F.lit(1)).alias("record_count"))
        counts.append(n.select(F.lit(feed).alias("table_name"), F.lit(mode).alias("mode"), "record_count"))
    return counts[0].unionByName(counts[1])


def _partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the fact by day and read it back, per day."""
    path = f"{_fresh_folder(spark)}/fact"
    sales = sample_warehouse(spark, sf_dir).sales
    tables.write_fact(star.without_derived(sales), path, derive=star.with_derived)
    return tables.stored(spark, path).groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount").cast("double").alias("revenue")
    )


def _clustered_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the fact along the curve, then read some products and some customers of it."""
    w, path = sample_warehouse(spark, sf_dir), f"{_fresh_folder(spark)}/fact"
    keys = {"customer_id": w.customers, "product_id": w.products}
    tables.write_fact(star.without_derived(w.sales), path, tables.Layout("month", slices=4), keys, star.with_derived)
    rows = tables.stored_fact(spark, path)
    parts = ((rows.filter("product_id BETWEEN '10' AND '19'"), "product"), (rows.filter("customer_id BETWEEN '10' AND '19'"), "customer"))
    return parts[0][0].select(F.lit("product").alias("filtered"), "transaction_id", F.col("amount").cast("double").alias("amount")).unionByName(
        parts[1][0].select(F.lit("customer").alias("filtered"), "transaction_id", F.col("amount").cast("double").alias("amount"))
    )


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export a report as CSV and read it back."""
    path = f"{_fresh_folder(spark)}/seasonal"
    report = analytics.seasonal_analysis(sample_warehouse(spark, sf_dir))
    tables.export_csv(report, path)
    return spark.read.option("header", True).schema(report.schema).csv(path)


def _ingestion_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_fresh_folder(spark)}/events"
    for feed, df in sample_feeds.all_feeds(spark, sf_dir).items():
        lake.log_ingestion(spark, path, feed, "raw", "SUCCESS", df.count(), at=NOW)
    return tables.stored(spark, path, schemas.INGESTION_EVENTS).select("source", "layer", "status", "record_count")


def _props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_feeds.table(spark, sf_dir, "events").select("event_id", "props")


def _first_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = contracts.first_record_report(_props(spark, sf_dir), "props", ["k", "source"], F.col("event_id"))
    return report.withColumn("missing_keys", F.array_join("missing_keys", ","))


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the landed sales into a staging table and count them by status."""
    folder = _fresh_folder(spark)
    sales = stream.read_stream(spark, landed_feeds(spark, sf_dir)["sales_transactions"])
    stream.load_stream(stream.first_deliveries(sales), f"{folder}/staging", f"{folder}/state").awaitTermination()
    return tables.stored(spark, f"{folder}/staging").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def _streamed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales in three deliveries, which share many sales, streamed into an empty fact one after the other."""
    folder = _fresh_folder(spark)
    tables.write_dimension(star.dim_customers(sample_feeds.customers(spark, sf_dir)), "dim_customers", f"{folder}/dim_customers")
    tables.write_dimension(star.dim_products(sample_feeds.products(spark, sf_dir)), "dim_products", f"{folder}/dim_products")
    feed = sample_feeds.transactions(spark, sf_dir)
    # files of a bounded number of records, a third of them a delivery; equal sales differ in hash, so deliveries share sales
    files = 1 + sample_feeds.table(spark, sf_dir, "lineitem").count() // (3 * lake.FILE_RECORDS)
    feed.repartition(3 * files, F.xxhash64(*feed.columns)).write.option("compression", "gzip").json(f"{folder}/arrived")
    target = fact_stream.Target(folder, f"{folder}/state", tables.Layout("month"))
    sales = fact_stream.arrivals(spark, f"{folder}/arrived", files_per_batch=files)
    fact_stream.stream_into_fact(sales, target, f"{folder}/progress").awaitTermination()
    return _show(tables.stored_fact(spark, target.fact))


SOURCES: dict[str, Query] = {
    "s1_latest_csv": _on_raw(lambda spark, raw: _customer_rows(spark, raw).drop("source_file")),
    "s2_api_pages": _on_raw(
        lambda spark, raw: documents.products_from_pages(documents.read_pages(spark, raw["products"]))
    ),
    "s3_campaign_documents": _on_raw(_campaign_documents),
    "s4_newest_per_status": _on_raw(lambda spark, raw: _sale_documents(spark, raw, None)),
    "s5_contract_report": _on_raw(_contract_report),
    "s6_json_keys": lambda spark, d: contracts.key_report(_props(spark, d), "props", ["k", "source"]),
    "s6_first_record": _first_record,
    "s13_documents": _on_raw(_all_sale_documents),
    "s14_layer_listing": _on_raw(lambda spark, raw: lake.list_layer(spark, raw["root"], "raw")),
    "s15_s16_staging_modes": _staging_modes,
    "s18_partitioned_write": _partitioned_write,
    "s18_clustered_read": _clustered_read,
    "s22_export": _export,
    "s23_file_freshness": _on_raw(lambda spark, raw: lake.file_freshness(spark, raw["root"], "raw")),
    "s24_ingestion_events": _ingestion_events,
}


def _on_results(build: Callable) -> Query:
    return _on_warehouse(lambda w: build(_results(w)))


def _health_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = sample_feeds.execution_log(spark, sf_dir)
    return monitoring.health_score(_results(sample_warehouse(spark, sf_dir)), log)


def _stored_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_fresh_folder(spark)}/daily_sales"
    monitoring.daily_sales(sample_warehouse(spark, sf_dir)).write.parquet(path)
    return _show(tables.stored(spark, path))


def _quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _fresh_folder(spark)
    monitoring.quarantine(sample_warehouse(spark, sf_dir).sales, folder)
    return tables.stored(spark, folder).filter("verdict = 'bad'").select("transaction_id", "reasons")


MONITORING: dict[str, Query] = {
    "d1_campaign_window": _on_warehouse(monitoring.outside_campaign_window),
    "d2_rules": lambda spark, d: monitoring.rule_violations(sample_feeds.all_feeds(spark, d)),
    "d3_campaign_kpis": _on_warehouse(monitoring.campaign_kpis),
    "d3_business_kpis": _on_warehouse(monitoring.business_kpis),
    "d4_daily_volumes": _on_warehouse(monitoring.daily_volumes),
    "d4_concurrent_campaigns": _on_warehouse(monitoring.concurrent_campaigns),
    "d4_catalogue_change": _on_warehouse(lambda w: monitoring.catalogue_change(w, 1900)),
    "d5_completeness_limits": _on_warehouse(monitoring.completeness_limits),
    "d6_health_score": _health_score,
    "d7_severity": _on_results(monitoring.severities),
    "d8_slow_steps": _on_log(monitoring.slow_steps),
    "d9_quarantine": _quarantined,
    "d10_daily_sales": _stored_rollup,
    "d11_streamed_sales": _streamed,
    "d11_streamed_fact": _streamed_fact,
    "d12_expected_records": lambda spark, d: monitoring.expected_records(sample_feeds.all_feeds(spark, d)),
}


def all_queries() -> dict[str, Query]:
    return {**STAR, **ANALYTICS, **QUALITY, **VALIDATION, **LINEAGE, **SOURCES, **MONITORING, **FEATURES}
