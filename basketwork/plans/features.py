"""Queries of the features that need tables, documents or deliveries of their own, on the sample tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketwork import schemas
from basketwork.operators import baselines, kept, lineage, lineage_views, monitoring, validation
from basketwork.plans.landing import landed_feeds
from basketwork.plans.warehouse import sample_warehouse
from basketwork.session import shared_dir
from basketwork.sources import contracts, deliveries, documents, lake, nested, registry, rescue, sample_feeds, tables
from basketwork.sources.sample_feeds import AS_OF
from basketwork.streaming import transactions as stream

NOW = dt.datetime.combine(AS_OF, dt.time(12))
SINCE = dt.date(1995, 1, 1)
NEWEST = 200
BUCKETS = 16


def fresh_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def _database(spark: SparkSession) -> str:
    """A new database of the catalogue."""
    name = f"sample_{uuid.uuid4().hex}"
    registry.use_database(spark, name)
    return name


def volume_statistical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: daily sales and new customers against the four weeks before each day."""
    w = sample_warehouse(spark, sf_dir)
    counts = baselines.daily_counts(
        {"fact_sales_transactions": (w.sales, "transaction_date"), "dim_customers": (w.customers, "registration_date")}, SINCE
    )
    return baselines.volume_statistical(baselines.every_day(counts))


def slow_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs against the median of their step on the two weeks before."""
    return baselines.slow_runs(sample_feeds.execution_log(spark, sf_dir))


def catalogue_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of the last day with a new product in each month, then every such day against the last one before it."""
    counts, path = monitoring.known_products(sample_warehouse(spark, sf_dir)), f"{fresh_folder(spark)}/snapshots"
    last = counts.groupBy(F.trunc("day", "MM").alias("month")).agg(F.max("day").alias("day")).select("day")
    for _ in range(2):  # a day keeps its snapshot when it is taken again
        monitoring.take_snapshots(counts.join(last, "day").select("day", "product_count"), path)
    return monitoring.change_since_snapshot(counts, tables.stored(spark, path))


def _history(spark: SparkSession, sf_dir: str) -> lineage.Lineage:
    seeds = lineage.seed(spark, NOW)
    captures = sample_feeds.captured_relationships(spark, sf_dir)
    return lineage.Lineage(seeds.sources, seeds.targets, seeds.transformations, captures)


def lineage_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every source and table feeds over any number of captured steps."""
    return lineage.lineage_reach(_history(spark, sf_dir))


def _view(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """Read one permanent view over the registry in the catalogue."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        database = _database(spark)
        lineage_views.publish(spark, _history(spark, sf_dir), database)
        rows = spark.table(f"{database}.{name}")
        times = [c for c, kind in rows.dtypes if kind == "timestamp"]
        return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})

    return query


def existence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse's tables in the catalogue, the campaigns not yet saved."""
    database, w = _database(spark), sample_warehouse(spark, sf_dir)
    for name in ("dim_customers", "dim_products", "fact_sales_transactions"):
        registry.save_table(w.tables[name], f"{database}.{name}")
    return validation.existence(spark, [f"{database}.{name}" for name in schemas.WAREHOUSE_TABLES])


def bucketed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and their sales sums, two tables bucketed by customer, joined without a shuffle."""
    database, w = _database(spark), sample_warehouse(spark, sf_dir)
    sums = w.sales.groupBy("customer_id").agg(F.count(F.lit(1)).alias("transactions"), F.sum("amount").alias("revenue"))
    registry.save_bucketed(sums, f"{database}.customer_sums", "customer_id", BUCKETS)
    registry.save_bucketed(w.customers, f"{database}.customers", "customer_id", BUCKETS)
    rows = spark.table(f"{database}.customers").hint("merge").join(spark.table(f"{database}.customer_sums"), "customer_id", "left")
    return rows.select(
        "customer_id", "country", F.coalesce("transactions", F.lit(0)).alias("transactions"), F.coalesce("revenue", F.lit(0)).cast("double").alias("revenue")
    )


def monthly_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days kept from incomplete sales, brought up to all sales, and months merged from the kept days."""
    sales, store = sample_warehouse(spark, sf_dir).sales, kept.Kept(f"{fresh_folder(spark)}/kept")
    late = F.col("transaction_date").between("1998-03-05", "1998-04-10") & F.col("payment_method").isin("CASH", "PAYPAL")
    kept.refresh(sales.filter(~late), store)
    kept.refresh(sales, store)
    return kept.monthly(spark, store)


def flattened_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The properties of events as typed columns."""
    events = nested.parsed(sample_feeds.table(spark, sf_dir, "events").select("event_id", "props"), "props")
    return nested.flatten(events, "document", ["event_id"]).rows


def _campaign_documents(spark: SparkSession, sf_dir: str) -> nested.Flattened:
    """Campaigns as nested documents, as an export of a document store delivers them, flattened again."""
    feed = sample_feeds.campaigns(spark, sf_dir).filter("start_date IS NOT NULL")
    money = F.struct(F.col("budget").cast("double").alias("planned"), F.col("actual_spend").cast("double").alias("spent"))
    step = lambda name, at: F.struct(F.lit(name).alias("name"), F.date_format(at, "yyyy-MM-dd").alias("day"))
    document = F.struct(
        F.struct("channel", F.struct(money.alias("money"), F.array("clicks", "conversions").alias("counts")).alias("figures")).alias("about"),
        F.array(step("start", "start_date"), step("end", "end_date")).alias("steps"), F.col("status"),
    )
    docs = nested.parsed(nested.as_documents(feed, "campaign_id", document), "json")
    return nested.flatten(docs, "document", ["campaign_id"])


def flattened_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _campaign_documents(spark, sf_dir).rows
    return rows.withColumns({
        "about_figures_counts": F.array_join("about_figures_counts", ","),
        **{c: F.col(c).cast("double") for c in ("about_figures_money_planned", "about_figures_money_spent")},
    })


def flattened_campaign_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _campaign_documents(spark, sf_dir).children["steps"].rows.select("campaign_id", F.col("position").cast("long"), "name", "day")


def rescued_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer drop with ages and dates that are none and records with a cell too many, counted by column."""
    path, key = f"{fresh_folder(spark)}/customers.csv", F.col("c_custkey")
    age = F.when(key % 31 == 0, "n/a").when(key % 31 == 1, "12.5 years").otherwise((key % 130).cast("string"))
    day = F.when(key % 37 == 0, "2001-13-45").otherwise("2001-01-31")
    line = F.concat_ws(",", key.cast("string"), "c_name", age, day, F.when(key % 41 == 0, "one too many"))
    lines = sample_feeds.table(spark, sf_dir, "customer").select(line.alias("value"))
    header = spark.range(1).select(F.lit("customer_id,first_name,age,registration_date").alias("value"))
    header.unionByName(lines).coalesce(1).write.text(path)
    return rescue.report(rescue.read_csv(spark, path, schemas.CUSTOMERS))


def delivery_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of customers, the second with all of the first; what each brings."""
    index = f"{_database(spark)}.customer_index"
    feed = sample_feeds.customers(spark, sf_dir)
    out = []
    for number, rows in enumerate((feed.filter(F.col("registration_date") < F.lit(AS_OF)), feed), 1):
        _, report = deliveries.take_delivery(rows, "customer_id", index, number, buckets=BUCKETS)
        out.append(report.select(F.lit(number).alias("delivery"), "status", "records"))
    return out[0].unionByName(out[1])


def newest_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 with its cap: the newest 200 documents of each status."""
    docs = documents.read_documents(spark, landed_feeds(spark, sf_dir)["sales_transactions"], "sales_transactions")
    return documents.sale_documents(docs, NEWEST).select("transaction_id", "status", F.to_date("transaction_date").alias("day"))


def schema_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 of the stored warehouse."""
    return validation.schema_listing(spark, sample_warehouse(spark, sf_dir).tables)


def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 without sizes, which differ from run to run."""
    from basketwork.plans.warehouse import sample_path

    return validation.table_listing(spark, sample_path(spark, sf_dir)).select("table_name", "row_count", (F.col("size_bytes") > 0).alias("has_bytes"))


def layer_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops of the raw layer by name, without their time stamps."""
    listed = lake.list_layer(spark, landed_feeds(spark, sf_dir)["root"], "raw")
    feed = F.regexp_extract("name", "^(.*)_[0-9]{8}_[0-9]{6}[.]", 1)
    return listed.groupBy(feed.alias("feed")).agg(F.count(F.lit(1)).alias("drops"), F.bool_and((F.col("files") > 0) & (F.col("bytes") > 0)).alias("filled"))


def freshness_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer as it is judged some hours after its newest file."""
    root = landed_feeds(spark, sf_dir)["root"]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/raw")
    newest = files.agg(F.max("modificationTime")).first()[0]
    out = []
    for hours in (0, 24, 25):
        found = lake.file_freshness(spark, root, "raw", F.lit(newest + dt.timedelta(hours=hours)))
        out.append(found.select(F.lit(hours).alias("hours_later"), "fresh", F.round("age_hours", 6).alias("age_hours")))
    return out[0].unionByName(out[1]).unionByName(out[2])


def streamed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D11 into staging: the distinct sales that arrive, whichever of several repeats is read first."""
    folder = fresh_folder(spark)
    sales = stream.read_stream(spark, landed_feeds(spark, sf_dir)["sales_transactions"])
    stream.load_stream(stream.first_deliveries(sales), f"{folder}/staging", f"{folder}/state").awaitTermination()
    return tables.stored(spark, f"{folder}/staging").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("transaction_id").alias("transactions"))


def enforced_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds without one required column; some must raise, others warn. Counts come from the reports."""
    rows = []
    for feed, lost in (("customers", "age"), ("products", "price"), ("marketing_campaigns", "channel"), ("sales_transactions", None)):
        df = sample_feeds.all_feeds(spark, sf_dir)[feed]
        report = contracts.column_report(df.drop(lost) if lost else df, schemas.REQUIRED[feed])
        mode = "raise" if feed in ("customers", "products") else "warn"
        try:
            contracts.enforce(report, feed, mode)
            outcome = "accepted"
        except contracts.ContractError:
            outcome = "raised"
        rows.append(report.select(F.lit(feed).alias("feed"), F.lit(outcome).alias("outcome"), "valid", "record_count"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load time and origin on every row of every feed."""
    out = []
    for feed, df in sample_feeds.all_feeds(spark, sf_dir).items():
        origin = schemas.METADATA[feed].fieldNames()[1]
        rows = lake.with_metadata(df, feed, f"drop of {feed}", F.lit(NOW))
        out.append(rows.groupBy(F.col("ingestion_timestamp").cast("timestamp_ntz").alias("loaded"), F.col(origin).alias("origin")).agg(F.count(F.lit(1)).alias("records")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def created_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a staging table when it is created, after a load, and when it is asked for again."""
    path, feed = f"{fresh_folder(spark)}/customers", sample_feeds.customers(spark, sf_dir)
    out = []
    for step in ("created", "loaded", "kept"):
        if step == "loaded":
            tables.write_staging(feed, path, "append")
        else:
            tables.create_if_absent(spark, path, feed.schema)
        n = tables.stored(spark, path, feed.schema).count()
        out.append((step, n))
    return spark.createDataFrame(out, "step string, records long")


FEATURES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q7_volume_statistical": volume_statistical,
    "d8_moving_baseline": slow_runs,
    "d4_catalogue_snapshots": catalogue_snapshots,
    "l7_reach": lineage_reach,
    "s21_view_complete_lineage": _view("v_complete_lineage"),
    "s21_view_field_lineage": _view("v_field_lineage"),
    "s21_view_quality_impact": _view("v_lineage_quality_impact"),
    "s21_view_dependencies": _view("v_pipeline_dependencies"),
    "s21_bucketed_customers": bucketed_customers,
    "g1_g5_existence": existence,
    "d10_monthly_from_days": monthly_from_days,
    "x13_flattened_events": flattened_events,
    "x13_flattened_campaigns": flattened_campaigns,
    "x13_flattened_campaign_steps": flattened_campaign_steps,
    "x13_rescued_cells": rescued_cells,
    "x13_delivery_duplicates": delivery_duplicates,
    "s4_newest_capped": newest_capped,
    "s7_enforced_contracts": enforced_contracts,
    "s8_metadata": metadata,
    "s17_created_if_absent": created_if_absent,
    "s14_layer_drops": layer_drops,
    "s23_freshness_limit": freshness_limit,
    "v1_table_rows": table_rows,
    "v3_schema_columns": schema_columns,
    "d11_streamed_transactions": streamed_transactions,
}
