"""What several operators share: tables, words, hash parts and scratch tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketwork.session import shared_dir

# White space of the word rule `[^\x20\x09-\x0D]+`.
SPACES = " \t\n\x0b\x0c\r"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text, none for null: split at runs of ASCII white space, empty pieces dropped."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), "")


def has_words(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(SPACES))) > 0


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that all executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: short lineage, safe from lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def carried(docs: DataFrame, **columns: Column) -> DataFrame:
    """Each row of `docs` as one struct, `_row`, beside columns of the operator's own: no name can clash."""
    return docs.select(F.struct("*").alias("_row"), *(c.alias(name) for name, c in columns.items()))


def restored(rows: DataFrame, docs: DataFrame, **results: Column) -> DataFrame:
    """The columns of `docs` again, and `results`, which replace columns of their names."""
    names = [*docs.columns, *(n for n in results if n not in docs.columns)]
    return rows.select(*(results.get(n, F.col("_row")[n]).alias(n) for n in names))


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, whatever the optimizer collapses."""
    return F.transform(F.array(value), body)[0]


