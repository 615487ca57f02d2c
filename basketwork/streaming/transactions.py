"""Continuous load of the transaction feed into its staging table.

Documents arrive as files. Each micro-batch is cleaned of repeated deliveries
within the lateness limit and appended; the batch transforms then dedupe the
rest. State is bounded by the watermark and kept on disk, and progress is kept in
a checkpoint in the shared folder, so a lost executor or driver resumes without loss.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketwork import schemas
from basketwork.sources.documents import SALE_STATUSES, fill_campaign
from basketwork.sources.lake import with_metadata

# Fixed value: how stale sales may be, and so how late a repeat may come.
STALENESS_MINUTES = 15

# The state has a key for each sale of the last minutes, all sales of a backlog among them: on disk, with a soft limit of
# memory per executor. A changelog is left off: with it, a backlog took over twice the memory and the time of tasks.
_STORE = "spark.sql.streaming.stateStore"
STATE_SETTINGS = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}


def read_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Sales documents of a folder as they arrive, in the read statuses."""
    reader = spark.readStream.schema(schemas.TRANSACTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return fill_campaign(reader.json(path).filter(F.col("status").isin(SALE_STATUSES)))


def first_deliveries(sales: DataFrame, minutes: int = STALENESS_MINUTES) -> DataFrame:
    """Drop repeats of a transaction that arrive within the staleness limit; the origin is added after the shuffle."""
    arrived = sales if "ingestion_timestamp" in sales.columns else sales.withColumn("ingestion_timestamp", F.current_timestamp())
    first = arrived.withWatermark("ingestion_timestamp", f"{minutes} minutes").dropDuplicatesWithinWatermark(["transaction_id"])
    return with_metadata(first, "sales_transactions", "sales_transactions")


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A stream takes its settings when it starts; those of the session are put back after that."""
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    try:
        for key, value in STATE_SETTINGS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def load_stream(sales: DataFrame, staging: str, checkpoint: str) -> StreamingQuery:
    """Append to the staging table until the available files are read.

    A checkpoint that was begun with another kind of state goes on with that one.
    """
    writer = sales.writeStream.format("parquet").outputMode("append").option("compression", "zstd")
    with _state_on_disk(sales.sparkSession):
        return writer.option("path", staging).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def staleness(sales: DataFrame, now: Column | None = None, minutes: int = STALENESS_MINUTES) -> DataFrame:
    """One row: minutes since the newest load and whether that is within the limit."""
    clock = F.current_timestamp() if now is None else now
    age = F.timestamp_diff("MINUTE", F.max("ingestion_timestamp"), clock)
    return sales.agg(age.alias("stale_minutes")).select(
        "stale_minutes", F.coalesce(F.col("stale_minutes") <= minutes, F.lit(False)).alias("within_limit")
    )
