"""Writing and reading stored tables: staging, warehouse, results."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketwork.sources.layout import DAY_COLUMN, MONTH_COLUMN, Layout, curve

# The columns each warehouse table is clustered by.
CLUSTERING = {
    "dim_customers": ["country", "registration_date"],
    "dim_products": ["category"],
    "dim_campaigns": ["channel", "start_date"],
    "fact_sales_transactions": ["customer_id", "product_id"],
}
FACT, PARTITION = "fact_sales_transactions", DAY_COLUMN


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything readable lies under `path`, on any file system Spark knows."""
    from pyspark.errors import AnalysisException

    try:
        return not spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
            "path"
        ).isEmpty()
    except AnalysisException:
        return False


def write_staging(df: DataFrame, path: str, mode: str) -> None:
    """`append` for the customer feed, `overwrite` for the feeds that replace their table."""
    df.write.mode(mode).parquet(path)


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty, typed table unless one exists."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def write_dimension(df: DataFrame, name: str, path: str) -> None:
    """Replace a dimension, clustered so that row groups can be skipped."""
    columns = CLUSTERING[name]
    df.hint("rebalance", columns[0]).sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def write_fact(
    df: DataFrame, path: str, layout: Layout = Layout(), keys: Mapping[str, DataFrame] | None = None, derive: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Replace the whole fact: by default one folder per day, clustered inside each file (see `Layout`).

    Rebalancing gathers a folder's rows, or those of each of its slices, in few files and lets AQE split a day that
    is far larger than the others, such as the placeholder for missing dates. Days that the new rows lack go. `keys`
    holds the dimensions that the ranges of the curve are taken from. `derive` adds columns that each row has in itself
    once the rows are gathered, so that they are not shuffled.
    """
    _in_folders(df, layout, keys, derive).option("partitionOverwriteMode", "static").parquet(path)


def replace_days(
    df: DataFrame, path: str, layout: Layout = Layout(), keys: Mapping[str, DataFrame] | None = None, derive: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Replace just the folders that `df` has rows of; others stay."""
    _in_folders(df, layout, keys, derive).option("partitionOverwriteMode", "dynamic").parquet(path)


def _in_folders(df: DataFrame, layout: Layout, keys: Mapping[str, DataFrame] | None, derive: Callable[[DataFrame], DataFrame] | None):
    rows, folder, derive = layout.with_folder(df), layout.column, derive or (lambda gathered: gathered)
    if layout.slices == 1:
        spread = derive(rows.hint("rebalance", folder)).sortWithinPartitions(folder, PARTITION, *CLUSTERING[FACT])
    else:
        places = 1 << layout.bits * len(CLUSTERING[FACT])
        part = F.floor(F.col("__place") * layout.slices / places).cast("int")
        sliced = rows.withColumn("__place", curve(df, CLUSTERING[FACT], layout.bits, keys)).withColumn("__slice", part)
        spread = derive(sliced.hint("rebalance", folder, "__slice")).sortWithinPartitions(folder, "__slice", PARTITION, "__place")
        spread = spread.drop("__place", "__slice")
    return spread.write.mode("overwrite").option("compression", "zstd").partitionBy(folder)


def stored_fact(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The fact in any layout, without the folder's own column."""
    return stored(spark, path, schema).drop(MONTH_COLUMN)


def append_rows(df: DataFrame, path: str) -> None:
    """Append to an append-only dataset (quality results, logs, events)."""
    df.write.mode("append").parquet(path)


def stored(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def stored_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, or no rows if nothing has been written to its folder yet."""
    from pyspark.errors import AnalysisException

    try:
        return stored(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def one_of(column: str, values: Iterable) -> Column:
    """Whether a date or text column has one of some values; as text, since each literal costs a call."""
    shown = [f"DATE'{v}'" if isinstance(v, dt.date) else "'" + str(v).replace("'", "\\'") + "'" for v in values]
    return F.expr(f"{column} IN ({', '.join(shown)})") if shown else F.lit(False)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove one partition folder of a stored table, on any file system Spark knows."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def export_csv(df: DataFrame, path: str, limit: int | None = None) -> int:
    """Write a report as CSV with header and return its row count."""
    from pyspark.sql import Observation

    seen = Observation()
    rows = df if limit is None else df.limit(limit)
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("header", True).csv(path)
    return int(seen.get["n"])


def small_table(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """A few fixed rows as a local relation: no Python workers, size known to the planner."""
    import pyarrow as pa

    return spark.createDataFrame(pa.table({name: [row[i] for row in rows] for i, name in enumerate(columns)}))
