"""Tables and views in Spark's catalogue: bucketed tables, existence checks, permanent views.

Entries last as long as the session's catalogue: with a metastore they outlive the application. Files go to the shared
folder, so that every executor and later applications see them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from basketwork.session import shared_dir


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{shared_dir(spark)}/databases/{name}'")


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).format("parquet").saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, mode: str = "overwrite") -> None:
    """A table dealt into `buckets` by a key and sorted by it: tables of equal buckets join on it without a shuffle.

    Meant for tables with one row, or few, per key: a dimension, or sales summed by key. Rows are dealt out before
    they are written, so each bucket is one file for each write.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def missing(spark: SparkSession, names: Iterable[str]) -> list[str]:
    """Names that are no table or view of the catalogue."""
    return [name for name in names if not spark.catalog.tableExists(name)]


def create_view(spark: SparkSession, name: str, text: str) -> None:
    """A permanent view, replaced if there is one."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")
