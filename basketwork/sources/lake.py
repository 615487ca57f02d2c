"""The file lake: layers of dated drops, read and written as Spark datasets.

A drop is a file or a folder of part files; its name carries the time it was
written. `binaryFile` lists drops without reading their content.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketwork import schemas
from basketwork.sources.tables import append_rows

# Layers, name of the time stamp, age limit.
LAYERS = ["raw", "processed", "curated"]
STAMP = "%Y%m%d_%H%M%S"
CUSTOMER_PREFIX = "synthetic_customers_"
KEEP_MARKER = ".keep"
MAX_AGE_HOURS = 24
FILE_RECORDS = 500_000  # of one compressed file

CSV_OPTIONS = {
    "header": True, "escape": '"', "multiLine": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Data files below a folder: path, modificationTime, length."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", "modificationTime", "length")


def list_layer(spark: SparkSession, lake: str, layer: str) -> DataFrame:
    """Drops of a layer with files and bytes, without folder markers."""
    name = F.regexp_extract("path", f"/{layer}/([^/]+)", 1)
    return (
        _files(spark, f"{lake}/{layer}")
        .filter(~F.col("path").endswith(KEEP_MARKER))
        .groupBy(name.alias("name"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def latest_drop(spark: SparkSession, folder: str, prefix: str) -> str:
    """Path of the newest drop whose name starts with `prefix`."""
    drops = _files(spark, f"{folder}/{prefix}*").select(
        F.regexp_extract("path", rf"^(.*/{prefix}[^/]*)", 1).alias("drop"), "modificationTime"
    )
    newest = drops.agg(F.max_by("drop", F.struct("modificationTime", "drop")).alias("drop")).first()["drop"]
    if newest is None:
        raise FileNotFoundError(f"no {prefix}* under {folder}")
    return newest


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV by column name; values that do not fit their type become null.

    Empty fields are null, quoted or not: CSV does not tell missing from empty.
    Columns the schema does not know stay text, columns the file lacks are
    absent, so the contract check sees the file as delivered.
    """
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    rows = spark.read.options(**CSV_OPTIONS).schema(text).csv(path)
    kinds = {field.name: field.dataType for field in schema.fields}
    return rows.select(
        *[F.col(name).try_cast(kinds[name]).alias(name) if name in kinds else F.col(name) for name in header]
    )


def read_latest_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the newest customer drop with the name of their drop."""
    drop = latest_drop(spark, folder, CUSTOMER_PREFIX)
    return read_csv(spark, drop, schemas.CUSTOMERS).withColumn("source_file", F.lit(drop.rsplit("/", 1)[-1]))


def drop_path(lake: str, layer: str, name: str, at: dt.datetime, kind: str) -> str:
    return f"{lake}/{layer}/{name}_{at.strftime(STAMP)}.{kind}"


def write_csv(df: DataFrame, lake: str, layer: str, name: str, at: dt.datetime, compression: str = "none") -> str:
    """A CSV drop with header; returns its path."""
    path = drop_path(lake, layer, name, at, "csv")
    df.write.options(**CSV_OPTIONS, compression=compression).csv(path)
    return path


def write_json(df: DataFrame, lake: str, layer: str, name: str, at: dt.datetime, compression: str = "none") -> str:
    """A JSON drop, one object per line, so that it splits and streams.

    Every object repeats all names, so a compressed drop has about a tenth of the bytes. A compressed file is read by
    one task; files of at most `FILE_RECORDS` records keep the drop in parts.
    """
    path = drop_path(lake, layer, name, at, "json")
    writer = df.write.option("ignoreNullFields", False).option("compression", compression)
    (writer if compression == "none" else writer.option("maxRecordsPerFile", FILE_RECORDS)).json(path)
    return path


def with_metadata(df: DataFrame, feed: str, origin: str, at: Column | None = None) -> DataFrame:
    """Load time and origin, under the column names of the feed."""
    now = F.current_timestamp() if at is None else at
    names = [f.name for f in schemas.METADATA[feed].fields]
    values = {
        name: now if name.endswith("timestamp") else F.lit(origin) for name in names if name not in df.columns
    }
    return df.withColumns(values)


def iso_timestamps(df: DataFrame) -> DataFrame:
    """Dates and times as ISO-8601 text."""
    formats = {"timestamp": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestamp_ntz": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
               "date": "yyyy-MM-dd"}
    return df.select(
        *[F.date_format(name, formats[kind]).alias(name) if kind in formats else F.col(name) for name, kind in df.dtypes]
    )


def file_freshness(
    spark: SparkSession, lake: str, layer: str, now: Column | None = None, max_age_hours: float = MAX_AGE_HOURS
) -> DataFrame:
    """One row: fresh, age_hours, latest_file; a layer without files is not fresh."""
    newest = _files(spark, f"{lake}/{layer}").agg(
        F.max("modificationTime").alias("at"), F.max_by("path", "modificationTime").alias("latest_file")
    )
    clock = F.current_timestamp() if now is None else now
    age = (F.unix_micros(clock) - F.unix_micros("at")) / 3600e6
    return newest.select(age.alias("age_hours"), "latest_file").select(
        F.coalesce(F.col("age_hours") <= max_age_hours, F.lit(False)).alias("fresh"), "age_hours", "latest_file"
    )


def log_ingestion(
    spark: SparkSession, path: str, source: str, layer: str, status: str, records: int = 0,
    error: str | None = None, at: dt.datetime | None = None,
) -> None:
    """Append one ingestion event."""
    at = at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = spark.createDataFrame([(at, source, layer, status, records, error)], schemas.INGESTION_EVENTS)
    append_rows(row.coalesce(1), path)
