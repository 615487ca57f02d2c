"""New, changed and repeated records of a delivery, told apart by a kept index of keys and content digests.

The index is a catalogue table bucketed by key: only the delivery is shuffled to meet it. It is append-only; of each key
the latest version counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketwork.functions.numbers import first_match
from basketwork.session import checkpointed
from basketwork.sources.registry import missing, save_bucketed

BUCKETS = 64
NEW, CHANGED, REPEATED, NO_KEY = "new", "changed", "repeated", "no_key"
INDEX = "key string, digest binary, delivery long, version int"


def content_digest(df: DataFrame, columns: list[str] | None = None) -> Column:
    """SHA-256 of a row's values in column order; null differs from every text."""
    names = columns or df.columns
    values = [F.coalesce(F.concat(F.lit("="), F.col(n).cast("string")), F.lit("-")) for n in names]
    marked = F.to_json(F.array(*values))
    return F.unhex(F.sha2(marked, 256))


def _latest(spark: SparkSession, index: str, delivery: int) -> DataFrame:
    """The last known digest of each key before a delivery, co-located with the index's buckets."""
    if missing(spark, [index]):
        return spark.createDataFrame([], "key string, known binary")
    rows = spark.table(index).filter(F.col("delivery") < delivery)
    return rows.groupBy("key").agg(F.max_by("digest", F.struct("delivery", "version")).alias("known"))


def classify(rows: DataFrame, key: str, index: str, delivery: int, columns: list[str] | None = None) -> DataFrame:
    """Distinct versions of a delivery: key, digest, version, copies (rows that hold it) and status.

    Against the index as it was before `delivery`: `repeated` is the latest known version of its key, `new` the first
    version (by digest) of a key that the index lacks, any other version is `changed`; rows without a key are
    `no_key`. Equal rows are counted on the map side before anything is sorted.
    """
    keyed = rows.select(F.col(key).cast("string").alias("key"), content_digest(rows, columns).alias("digest"))
    versions = keyed.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("copies"))
    known = _latest(rows.sparkSession, index, delivery)
    joined = versions.join(known, "key", "left")
    same = F.col("digest") == F.col("known")
    order = Window.partitionBy("key").orderBy(F.coalesce(same, F.lit(False)).desc(), "digest")
    ranked = joined.withColumn("version", F.row_number().over(order))
    rules = [
        (F.col("key").isNull(), NO_KEY), (same, REPEATED), (F.col("known").isNull() & (F.col("version") == 1), NEW),
    ]
    return ranked.select("key", "digest", "version", "copies", first_match(rules, CHANGED).alias("status"))


def take_delivery(
    rows: DataFrame, key: str, index: str, delivery: int, columns: list[str] | None = None, buckets: int = BUCKETS
) -> tuple[DataFrame, DataFrame]:
    """Classify a delivery and enter what it brings into the index.

    Returns the rows to append, one for each new or changed version, and the report of `summary`. `delivery` numbers
    deliveries upwards; taking the same one again gives the same, since the index is read as it was before it.
    """
    spark = rows.sparkSession
    found = checkpointed(classify(rows, key, index, delivery, columns))
    if missing(spark, [index]):
        save_bucketed(spark.createDataFrame([], INDEX), index, "key", buckets)
    entered = spark.table(index).filter(F.col("delivery") == delivery)
    brought = found.filter(F.col("status").isin(NEW, CHANGED)).withColumn("delivery", F.lit(delivery).cast("long"))
    if entered.isEmpty():
        save_bucketed(brought.select("key", "digest", "delivery", "version"), index, "key", buckets, "append")
    marked = rows.withColumn("__digest", content_digest(rows, columns)).withColumn("__key", F.col(key).cast("string"))
    one = marked.dropDuplicates(["__key", "__digest"])
    versions = brought.select(F.col("key").alias("__key"), F.col("digest").alias("__digest"))
    return one.join(versions, ["__key", "__digest"], "left_semi").drop("__key", "__digest"), summary(found)


def summary(found: DataFrame) -> DataFrame:
    """status, records: rows of a delivery; further copies of a version count as repeated."""
    first = found.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("all"))
    extra = first.filter(F.col("status").isin(NEW, CHANGED)).select(F.lit(REPEATED).alias("status"), (F.col("all") - F.col("n")).alias("records"))
    whole = F.when(F.col("status").isin(REPEATED, NO_KEY), F.col("all")).otherwise(F.col("n"))
    rows = first.select("status", whole.alias("records")).unionByName(extra)
    return rows.groupBy("status").agg(F.sum("records").alias("records")).filter("records > 0")
