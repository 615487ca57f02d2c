"""The whole pipeline: ingest, gate, star schema, gate, quality, lineage.

One driver program; every stage is a Spark job over files. Nothing but counts
and one-row reports reaches the driver.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketwork import schemas
from basketwork.operators import lineage, quality, validation
from basketwork.operators.lineage_seeds import CAPTURES
from basketwork.operators.warehouse import Warehouse
from basketwork.plans import warehouse as warehouses
from basketwork.sources import contracts, documents, lake
from basketwork.sources.tables import append_rows, create_if_absent, path_exists, stored, write_staging

# Steps of the pipeline by feed, and what a broken contract does.
STEPS = {
    "customers": ("csv_ingestion_pipeline", "load_to_bigquery"),
    "products": ("api_ingestion_pipeline", "load_to_bigquery"),
    "marketing_campaigns": ("firestore_ingestion_pipeline", "load_campaigns_to_bigquery"),
    "sales_transactions": ("firestore_ingestion_pipeline", "load_transactions_to_bigquery"),
}
STAGING_MODES = {
    "customers": "append",
    "products": "overwrite",
    "marketing_campaigns": "overwrite",
    "sales_transactions": "overwrite",
}
ON_VIOLATION = {"customers": "raise", "products": "raise", "marketing_campaigns": "warn", "sales_transactions": "warn"}


@dataclass
class Layout:
    """Folders of one installation."""

    root: str

    def __getattr__(self, name: str) -> str:
        folders = {"lake", "staging", "warehouse", "quality", "lineage", "events", "runs"}
        if name not in folders:
            raise AttributeError(name)
        return f"{self.root}/{name}"


@dataclass
class Run:
    """What a pipeline run reports (G6) and appends to the table of runs."""

    staging_counts: dict[str, int]
    warehouse_counts: dict[str, int]
    health: str
    duration_seconds: float
    log_errors: list[str] = field(default_factory=list)


def _form(feed: str) -> tuple[T.StructType, str | None]:
    """Schema of a feed's JSON lines, and the list in them that holds the records."""
    return (schemas.PRODUCT_PAGE, "data") if feed == "products" else (schemas.FEEDS[feed], None)


def read_raw(spark: SparkSession, raw: dict[str, str], feed: str, cap: int | None = None, seen: Observation | None = None) -> DataFrame:
    """A feed as delivered: newest customer drop, product pages or documents; `seen` gets the key counts."""
    if feed == "customers":
        return lake.read_latest_customers(spark, f"{raw['root']}/raw")
    schema, inside = _form(feed)
    docs = documents.delivered(spark, raw[feed], schema, schemas.REQUIRED[feed], seen or Observation(), inside)
    if feed == "products":
        return documents.products_from_pages(docs)
    if feed == "marketing_campaigns":
        return documents.with_status(docs)
    return documents.fill_campaign(documents.sale_documents(docs, cap))


def ingest(spark: SparkSession, layout: Layout, raw: dict[str, str], feed: str, at: dt.datetime, cap: int | None) -> int:
    """Contract, metadata, copy to the lake, staging table; returns the record count."""
    keys = Observation()
    rows = read_raw(spark, raw, feed, cap, keys)
    contracts.require_columns(rows, schemas.REQUIRED[feed], feed, ON_VIOLATION[feed])
    rows = lake.with_metadata(rows, feed, raw.get(feed, feed), F.lit(at))
    schema = schemas.STAGING[feed]
    typed = rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
    seen = Observation()
    counted = typed.observe(seen, F.count(F.lit(1)).alias("n"))
    # the raw feed is evaluated once, for the lake; staging loads that typed drop
    loaded = spark.read.schema(schema).json(lake.write_json(counted, layout.lake, "processed", feed, at))
    records, rejected = int(seen.get["n"]), 0
    if feed == "customers":
        lake.write_csv(loaded, layout.lake, "processed", feed, at)
        if not records:
            contracts.violated(f"{feed}: no records", ON_VIOLATION[feed])
    else:
        contracts.require_keys(keys.get, schemas.REQUIRED[feed], feed, ON_VIOLATION[feed])
        rejected = int(keys.get["rejected"])
    if rejected:
        documents.rejects(spark, raw[feed], _form(feed)[0]).write.mode("append").text(f"{layout.lake}/rejected/{feed}")
    path = f"{layout.staging}/{feed}"
    create_if_absent(spark, path, schema)
    write_staging(loaded, path, STAGING_MODES[feed])
    error = f"{rejected} records rejected" if rejected else None
    lake.log_ingestion(spark, layout.events, feed, "processed", "SUCCESS", records, error, at=at)
    return records


def staging(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {feed: stored(spark, f"{layout.staging}/{feed}", schemas.STAGING[feed]) for feed in schemas.FEEDS}


def transform(spark: SparkSession, layout: Layout, as_of: dt.date, at: dt.datetime) -> Warehouse:
    """Staging to warehouse; the staging tables must exist."""
    validation.require_folders(spark, [f"{layout.staging}/{feed}" for feed in schemas.FEEDS])
    return warehouses.build(staging(spark, layout), layout.warehouse, as_of, F.lit(at))


def check(w: Warehouse, layout: Layout, at: dt.datetime) -> str:
    """Run all checks, append their results and return the day's health (Q8, Q9)."""
    spark = w.sales.sparkSession
    create_if_absent(spark, layout.quality, schemas.QUALITY_RESULTS)
    append_rows(quality.run_all(w, at).coalesce(1), layout.quality)
    return day_health(spark, layout, at.date())


def day_health(spark: SparkSession, layout: Layout, day: dt.date) -> str:
    """HEALTHY or UNHEALTHY; UNKNOWN when results cannot be read."""
    try:
        results = stored(spark, layout.quality, schemas.QUALITY_RESULTS)
        return quality.system_health(results, day).first()["system_health"]
    except Exception:
        return "UNKNOWN"


def run(
    spark: SparkSession,
    root: str,
    raw: dict[str, str],
    as_of: dt.date,
    at: dt.datetime,
    cap: int | None = None,
    raise_when_unhealthy: bool = False,
) -> Run:
    """One full run over raw drops (`landing.land` shows their form)."""
    layout = Layout(root)
    started = dt.datetime.now()
    run_id = f"run_{at:%Y%m%d_%H%M%S}"
    tracker = lineage.Tracker(spark, layout.lineage, run_id=run_id)
    for feed in schemas.FEEDS:
        with tracker.step(*STEPS[feed], source_table=feed, target_table=f"staging_area.{feed}") as step:
            step.records = ingest(spark, layout, raw, feed, at, cap)
        capture_of(tracker, step, feed)
    staging_counts = validation.require_rows(staging(spark, layout))
    with tracker.step("transformation_dag", "transform", "staging_area", "data_warehouse") as step:
        w = transform(spark, layout, as_of, at)
        warehouse_counts = validation.require_rows(w.tables)
        step.records = sum(warehouse_counts.values())
    for table in schemas.WAREHOUSE_TABLES:
        capture_of(tracker, step, table)
    with tracker.step("data_quality_dag", "quality_checks", "data_warehouse", "data_quality_results"):
        health = check(w, layout, at)
    seconds = (dt.datetime.now() - started).total_seconds()
    done = Run(staging_counts, warehouse_counts, health, seconds, tracker.errors)
    log_run(spark, layout, done, run_id, at)
    if raise_when_unhealthy and health != "HEALTHY":
        raise validation.GateError(f"system health is {health}")
    return done


def log_run(spark: SparkSession, layout: Layout, done: Run, run_id: str, at: dt.datetime) -> None:
    """One row of the run's figures in the append-only table of runs; a gate that stops a run leaves none."""
    counts = (sum(done.staging_counts.values()), sum(done.warehouse_counts.values()))
    row = (run_id, at, done.duration_seconds, *counts, done.health, len(done.log_errors))
    append_rows(spark.createDataFrame([row], schemas.PIPELINE_RUNS).coalesce(1), layout.runs)


def capture_of(tracker: lineage.Tracker, step: lineage.Step, name: str) -> None:
    source_id, target_id, rule, kind, confidence, pipeline = CAPTURES[name]
    tracker.capture(step, pipeline, source_id, target_id, rule, kind, confidence)


def lineage_of(spark: SparkSession, layout: Layout, at: dt.datetime) -> lineage.Lineage:
    """The seeded registry with all captured relationships."""
    registry = lineage.seed(spark, at)
    path = f"{layout.lineage}/relationships"
    if path_exists(spark, path):
        captured = stored(spark, path, schemas.LINEAGE_RELATIONSHIPS)
        registry.relationships = registry.relationships.unionByName(captured)
    return registry
