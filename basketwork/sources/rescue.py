"""CSV with type conversion that loses nothing: bad cells are kept beside the row, broken records apart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketwork.sources.lake import CSV_OPTIONS

BROKEN = "_broken_record"
RESCUED = "rescued"


@dataclass
class Rescued:
    """`rows`: typed columns and `rescued`, a map from column to the text that did not fit, null if all did.

    `broken`: the text of records with too few or too many cells, which are in no row.
    """

    rows: DataFrame
    broken: DataFrame


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> Rescued:
    """Header CSV by column name, every cell typed or kept as text.

    A cell is rescued if it holds text and the cast to its column's type gives null. Columns the schema does not know
    stay text; columns that the file lacks are null. Empty cells are null and need no rescue.
    """
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    text = T.StructType([T.StructField(name, T.StringType()) for name in [*header, BROKEN]])
    cells = spark.read.options(**CSV_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN).schema(text).csv(path)
    # the text of a broken record cannot be asked for alone, so the test names a cell too
    first = F.coalesce(header[0], F.lit(""))
    is_whole = F.concat_ws("", first, BROKEN).eqNullSafe(first)
    whole = cells.filter(is_whole)
    kinds = {f.name: f.dataType for f in schema.fields}
    typed = {name: F.col(name).try_cast(kinds[name]) if name in kinds else F.col(name) for name in header}
    lost = [
        F.when(F.col(name).isNotNull() & value.isNull(), F.struct(F.lit(name).alias("k"), F.col(name).alias("v")))
        for name, value in typed.items()
    ]
    entries = F.filter(F.array(*lost), lambda e: e.isNotNull())
    absent = [F.lit(None).cast(k).alias(n) for n, k in kinds.items() if n not in typed]
    rows = whole.select(
        *(v.alias(n) for n, v in typed.items()), *absent,
        F.when(F.size(entries) > 0, F.map_from_entries(entries)).alias(RESCUED),
    )
    return Rescued(rows, cells.filter(~is_whole).select(F.col(BROKEN).alias("record")))


def report(found: Rescued) -> DataFrame:
    """column_name, cells: rescued cells of each column, and broken records under `(record)`."""
    cells = found.rows.select(F.explode(F.map_keys(RESCUED)).alias("column_name"))
    records = found.broken.select(F.lit("(record)").alias("column_name"))
    return cells.unionByName(records).groupBy("column_name").agg(F.count(F.lit(1)).alias("cells"))
