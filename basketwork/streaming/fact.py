"""Sales streamed into the fact table: each micro-batch replaces the folders of the days it touches.

After every batch the fact equals the batch transform over all rows delivered so far, whatever their order: repeats,
better versions of a sale, versions on another day, and sales that leave the fact.

* `state` keeps the best delivered row of each sale per batch, in a folder of that batch's id, written once.
* A batch reads the earlier versions of its own sales, ranks all versions anew and joins them to the dimensions as
  they are stored at that moment.
* Days of any version are touched. Their folders are written again from what they hold, without the sales of the
  batch, and the batch's rows. Folders that end without rows are removed.

Spark repeats a batch after a failure with the same id and rows. It then finds the same earlier versions, since those
have smaller ids, so the same folders get the same rows: a batch may stop anywhere and be done again.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from basketwork import schemas
from basketwork.operators import star
from basketwork.sources import tables
from basketwork.sources.layout import Layout

STATE_SCHEMA = T.StructType([*schemas.TRANSACTIONS.fields, T.StructField("batch_id", T.LongType())])


@dataclass(frozen=True)
class Target:
    """Where a stream of sales ends: the warehouse's folder, its layout, and the folder of the stream's state."""

    warehouse: str
    state: str
    layout: Layout = Layout()
    loaded_at: Column | None = None
    empty_campaign_as_null: bool = False

    @property
    def fact(self) -> str:
        return f"{self.warehouse}/{tables.FACT}"


def arrivals(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Sales documents of a folder as they arrive, in every status."""
    reader = spark.readStream.schema(schemas.TRANSACTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def _versions(spark: SparkSession, target: Target, batch_id: int) -> DataFrame:
    """The batch's sales in all their versions up to now.

    The batch's own rows go through the semi-join too, so its rows stay dealt out by sale for the rank that follows.
    """
    state = tables.stored_or_empty(spark, target.state, STATE_SCHEMA)
    if state.filter(F.col("batch_id") < batch_id).isEmpty():
        return _of_batch(state, batch_id)
    ids = _of_batch(state, batch_id).select("transaction_id")
    return state.filter(F.col("batch_id") <= batch_id).join(ids, "transaction_id", "left_semi")


def _of_batch(state: DataFrame, batch_id: int) -> DataFrame:
    return state.filter(F.col("batch_id") == batch_id)


def _scratch(spark: SparkSession, target: Target, name: str, rows: DataFrame) -> DataFrame:
    """Rows that several steps of a batch read, in a folder beside the state that the next batch replaces."""
    path = f"{target.state}-scratch/{name}"
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return tables.stored(spark, path, rows.schema)


def _folder(target: Target) -> Column:
    day = F.coalesce(F.to_date("transaction_date"), F.lit(star.FIRST_DATE))
    return day if target.layout.folder == "day" else F.date_format(day, "yyyy-MM")


def _with_folders(rows: DataFrame, target: Target) -> tuple[DataFrame, Observation]:
    """`rows`, and the names of their folders as `folders`, known once a job has read all of the rows."""
    seen = Observation()
    return rows.observe(seen, F.collect_set(_folder(target).cast("string")).alias("folders")), seen


def merge_batch(batch: DataFrame, batch_id: int, target: Target) -> None:
    """Bring one micro-batch of raw sales into the fact; doing it again changes nothing.

    Sales without an id are left out, as in the transform. Three jobs: the best rows of the batch, the best versions
    of its sales, the touched folders. The lists of folders, which the calendar bounds, are all that reaches the
    driver; the jobs that need the rows anyway make them.
    """
    spark, column = batch.sparkSession, target.layout.column
    best = star.best_transactions(batch.select(*schemas.TRANSACTIONS.fieldNames()))
    keep = best.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").partitionBy("batch_id")
    keep.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(target.state)
    ours = _of_batch(tables.stored_or_empty(spark, target.state, STATE_SCHEMA), batch_id)
    if ours.isEmpty():
        return
    versions = _versions(spark, target, batch_id).select(*star.FACT_SOURCES)
    cleaned = star.cleaned_sales(versions, target.loaded_at, target.empty_campaign_as_null)
    fact = tables.stored_or_empty(spark, target.fact, target.layout.with_folder(star.with_derived(cleaned)).schema)
    watched, touched = _with_folders(versions, target)
    customers, products = (tables.stored(spark, f"{target.warehouse}/{n}") for n in ("dim_customers", "dim_products"))
    found = star.kept_sales(watched, customers, products, target.loaded_at, target.empty_campaign_as_null, counted=ours)
    rows = _scratch(spark, target, "rows", found)
    folders = touched.get["folders"]
    days = [dt.date.fromisoformat(f) for f in folders] if target.layout.folder == "day" else folders
    there = fact.filter(tables.one_of(column, days)).select(*rows.columns)
    kept = there.join(ours.select("transaction_id"), "transaction_id", "left_anti").select(*rows.columns)
    both, filled = _with_folders(kept.unionByName(rows), target)
    tables.replace_days(both, target.fact, target.layout, {"customer_id": customers, "product_id": products}, star.with_derived)
    for folder in set(folders) - set(filled.get["folders"]):
        tables.remove_folder(spark, f"{target.fact}/{column}={folder}")


def stream_into_fact(sales: DataFrame, target: Target, checkpoint: str) -> StreamingQuery:
    """Merge all files that are there now, batch by batch; later calls with the same `checkpoint` go on from there."""
    return (
        sales.writeStream.foreachBatch(lambda batch, batch_id: merge_batch(batch, batch_id, target))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compact_state(spark: SparkSession, target: Target, up_to: int) -> None:
    """Keep only the best version of each sale among the batches up to `up_to`, which must have ended.

    They become one folder; the others are removed after it is written, and are harmless until then.
    """
    state = tables.stored_or_empty(spark, target.state, STATE_SCHEMA).filter(F.col("batch_id") <= up_to)
    old = [r[0] for r in state.select("batch_id").distinct().collect()]
    best = _scratch(spark, target, "compacted", star.best_transactions(state.drop("batch_id")))
    merged = best.withColumn("batch_id", F.lit(up_to).cast("long")).write.mode("overwrite").partitionBy("batch_id")
    merged.option("partitionOverwriteMode", "dynamic").parquet(target.state)
    for batch_id in old:
        if batch_id != up_to:
            tables.remove_folder(spark, f"{target.state}/batch_id={batch_id}")
