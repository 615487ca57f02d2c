"""Daily sales kept up to date by days: sums, and bitmaps of buyers that merge into months.

Only days whose sales changed are computed again. Distinct buyers do not add up over days; their bitmaps do: a month
is the union of its days' bitmaps, exact and without reading sales. A buyer's bit is a number that is given once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketwork.operators.joins import attach, column_bytes
from basketwork.session import checkpointed
from basketwork.sources import tables

FOLDER = "sales_month"
TOTALS = f"day date, transactions long, revenue decimal(38,2), units long, digest long, {FOLDER} string"
BUYERS = f"day date, bucket long, buyers binary, {FOLDER} string"
NUMBERS = "customer_id string, number long"


@dataclass(frozen=True)
class Kept:
    """Folder of the kept tables: `totals` and `buyers` by month, and `numbers` of customers."""

    path: str

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        schema = spark.createDataFrame([], {"totals": TOTALS, "buyers": BUYERS, "numbers": NUMBERS}[name]).schema
        return tables.stored_or_empty(spark, f"{self.path}/{name}", schema)


def number_customers(sales: DataFrame, kept: Kept) -> DataFrame:
    """customer_id, number of all buyers; those without a number get the next ones, which never change.

    Numbers count up within each task, from a start of the task's own, so no task sees all customers.
    """
    spark = sales.sparkSession
    known = kept.read(spark, "numbers")
    ids = sales.select("customer_id").distinct()
    last = known.agg(F.coalesce(F.max("number"), F.lit(-1))).first()[0]
    first = (last >> 33) + 1  # task numbers are the bits above the lower 33
    new = ids.join(known, "customer_id", "left_anti").withColumn("number", F.monotonically_increasing_id() + (first << 33))
    new.write.mode("append").parquet(f"{kept.path}/numbers")
    return kept.read(spark, "numbers")


def daily_totals(sales: DataFrame) -> DataFrame:
    """Sums per day, and a digest of the day's sales that tells whether they changed."""
    row = F.xxhash64("transaction_id", "customer_id", "amount", "quantity")
    return sales.groupBy(F.col("transaction_date").alias("day")).agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount").cast("decimal(38,2)").alias("revenue"),
        F.sum("quantity").alias("units"), F.bit_xor(row).alias("digest"),
    ).withColumn(FOLDER, F.date_format("day", "yyyy-MM"))


def daily_buyers(sales: DataFrame, numbers: DataFrame) -> DataFrame:
    """Bitmaps of the numbers of each day's buyers; a customer is one row per day before the join."""
    pairs = sales.select(F.col("transaction_date").alias("day"), "customer_id").distinct()
    size = sum(column_bytes(numbers).values())
    numbered = attach(pairs.withColumn("at", F.concat_ws("@", "customer_id", "day")), numbers, "customer_id", "inner", size, "at")
    return numbered.groupBy("day", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("buyers")
    ).withColumn(FOLDER, F.date_format("day", "yyyy-MM"))


def _replaced(spark: SparkSession, kept: Kept, name: str, new: DataFrame, days: list) -> None:
    """Write the months of `days` again: other days as they are, these as in `new`."""
    months = sorted({f"{d:%Y-%m}" for d in days})
    there = kept.read(spark, name).filter(tables.one_of(FOLDER, months) & ~tables.one_of("day", days))
    both, path = there.unionByName(checkpointed(new)), f"{kept.path}/{name}"
    filled = {r[0] for r in both.select(FOLDER).distinct().collect()}
    both.hint("rebalance", FOLDER).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(FOLDER).parquet(path)
    for month in set(months) - filled:
        tables.remove_folder(spark, f"{path}/{FOLDER}={month}")


def refresh(sales: DataFrame, kept: Kept, days: list | None = None) -> list:
    """Bring the kept tables up to the sales; returns the days that were computed again.

    Days are compared by count, sum and digest; the calendar bounds their list. With `days`, such as those that a
    stream has touched, only these are read and compared. Bitmaps are written before the totals, so a run that broke
    off finds the same days changed.
    """
    spark, before = sales.sparkSession, kept.read(sales.sparkSession, "totals")
    if days is not None:
        sales, before = sales.filter(tables.one_of("transaction_date", days)), before.filter(tables.one_of("day", days))
    now = checkpointed(daily_totals(sales))
    equal = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("transactions", "revenue", "units", "digest")]
    same = equal[0] & equal[1] & equal[2] & equal[3]
    changed = now.alias("a").join(before.alias("b"), "day", "full_outer").filter(~same).select("day")
    days = sorted(r.day for r in changed.collect())
    if days:
        part = sales.filter(tables.one_of("transaction_date", days))
        _replaced(spark, kept, "buyers", daily_buyers(part, number_customers(part, kept)), days)
        _replaced(spark, kept, "totals", now.filter(tables.one_of("day", days)), days)
    return days


def monthly(spark: SparkSession, kept: Kept) -> DataFrame:
    """month, transactions, revenue, units and distinct buyers, from the kept days alone."""
    sums = kept.read(spark, "totals").groupBy(F.col(FOLDER).alias("month")).agg(
        F.sum("transactions").alias("transactions"), F.sum("revenue").cast("double").alias("revenue"), F.sum("units").alias("units")
    )
    merged = kept.read(spark, "buyers").groupBy(F.col(FOLDER).alias("month"), "bucket").agg(F.bitmap_or_agg("buyers").alias("buyers"))
    distinct = merged.groupBy("month").agg(F.sum(F.bitmap_count("buyers")).alias("buyers"))
    return sums.join(distinct, "month")
