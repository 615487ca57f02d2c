"""Product pages and exported documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketwork import schemas

# Page status, statuses read from the document export.
PAGE_OK = "success"
PAGE_SIZE = 50
SALE_STATUSES = ["completed", "pending", "cancelled"]

_NO_DAY = "0001-01-01"  # sales without date count as oldest


class PageError(RuntimeError):
    """A product page reports an error."""


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PRODUCT_PAGE).json(path)


def products_from_pages(pages: DataFrame) -> DataFrame:
    """Products of all pages up to the first that is empty or says it is the last.

    A page within that range whose status is not success is an error. The range
    is found by two minimums, so pages are never put in order.
    """
    page = F.col("page")
    ends = F.coalesce(F.size("data") < 1, F.lit(True)) | ~F.coalesce(F.col("pagination.has_next"), F.lit(False))
    failed = ~F.coalesce(F.col("status") == PAGE_OK, F.lit(False))
    limits = pages.agg(
        F.min(F.when(ends, page)).alias("last"),
        F.min(F.when(failed, page)).alias("failed"),
    ).first()
    last, bad = limits["last"], limits["failed"]
    if bad is not None and (last is None or bad <= last):
        raise PageError(f"page {bad} reports an error")
    kept = pages if last is None else pages.filter(page <= last)
    return kept.select(F.inline("data"))


def read_documents(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Line-delimited documents with the explicit schema of their feed."""
    return spark.read.schema(schemas.FEEDS[feed]).json(path)


_CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])


def delivered(spark: SparkSession, path: str, schema: T.StructType, required: list[str], seen: Observation, inside: str | None = None) -> DataFrame:
    """Parsed lines of a feed; `seen` gets n, rejected and missing_0.. (one per required key) on the way.

    Keys are counted on the delivered text, before the schema fills what is absent, in the pass
    that reads the rows. `inside` names the list whose elements have the keys, as in pages.
    Lines that are no JSON object are rejected: counted here, kept by `rejects`.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", _with_corrupt(schema), {"columnNameOfCorruptRecord": _CORRUPT}).alias("r"))
    if inside:
        items = F.from_json("value", f"{inside} array<map<string,string>>")[inside]
        number = F.coalesce(F.size(items), F.lit(0))
        lacking = lambda key: F.size(F.filter(items, lambda m: ~F.map_contains_key(m, key)))
    else:
        keys = F.json_object_keys("value")
        number = F.lit(1)
        lacking = lambda key: (~F.array_contains(keys, key)).cast("int")
    good = F.col("r").isNotNull() & F.col(f"r.{_CORRUPT}").isNull()
    counts = [F.coalesce(F.sum(F.when(good, lacking(key))), F.lit(0)).alias(f"missing_{i}") for i, key in enumerate(required)]
    watched = parsed.observe(
        seen, F.coalesce(F.sum(F.when(good, number)), F.lit(0)).alias("n"), F.count(F.when(~good, 1)).alias("rejected"), *counts
    )
    return watched.filter(good).select("r.*").drop(_CORRUPT)


def rejects(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The lines of a feed that `delivered` rejects, as text."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    record = F.from_json("value", _with_corrupt(schema), {"columnNameOfCorruptRecord": _CORRUPT})
    return lines.withColumn("r", record).filter(F.col("r").isNull() | F.col(f"r.{_CORRUPT}").isNotNull()).select("value")


def with_status(docs: DataFrame) -> DataFrame:
    """S3 without the order, which a landing does not need and which would read the feed twice."""
    return docs.filter(F.col("status") >= "")


def campaign_documents(docs: DataFrame) -> DataFrame:
    """S3: documents with a status, by status and newest start."""
    return with_status(docs).orderBy("status", F.desc_nulls_last("start_date"), "document_id")


def fill_campaign(sales: DataFrame) -> DataFrame:
    """Sales without campaign carry an empty campaign id."""
    return sales.withColumn("campaign_id", F.coalesce("campaign_id", F.lit("")))


def newest_first(sales: DataFrame, statuses: list[str] | None = None) -> DataFrame:
    """S4's order: status by status as they are read, in each the newest first, those without date last.

    A sort over ranges of all keys, so no task gathers a status. A landing does not need it.
    """
    place = F.array_position(F.array(*map(F.lit, statuses or SALE_STATUSES)), F.col("status"))
    return sales.orderBy(place, F.desc_nulls_last("transaction_date"), "transaction_id", "document_id")


def sale_documents(docs: DataFrame, cap: int | None = None, statuses: list[str] | None = None) -> DataFrame:
    """Sales in the read statuses, in no order (see `newest_first`); `cap`, off by default, keeps the newest `cap` of each.

    With a cap, a count per status and day finds the day each status is cut on. Newer days pass
    without any shuffle; only the cut day is ranked, first within shares and then among the
    survivors. Both ranks have the literal cap, so each task passes on at most `cap` rows of a
    share; the number of shares is the square root of the day's rows over the cap, so neither
    step gathers more than the geometric mean of the two.
    """
    kept = docs.filter(F.col("status").isin(statuses or SALE_STATUSES))
    if cap is None:
        return kept
    day = F.coalesce(F.to_date("transaction_date"), F.to_date(F.lit(_NO_DAY)))
    dated = kept.withColumn("__day", day)
    cut = _cut_days(dated, cap)
    marked = dated.join(F.broadcast(cut), "status", "left")  # one row per status
    whole_days = marked.filter(F.col("__cut").isNull() | (F.col("__day") > F.col("__cut")))
    cut_day = marked.filter(F.col("__day") == F.col("__cut"))
    return whole_days.select(*docs.columns).unionByName(_newest(cut_day, docs.columns, cap).select(*docs.columns))


def _cut_days(dated: DataFrame, cap: int) -> DataFrame:
    """Per status with at least `cap` rows: the day of the last kept row and its quota."""
    per_day = dated.groupBy("status", "__day").agg(F.count(F.lit(1)).alias("n"))
    newer = F.sum("n").over(Window.partitionBy("status").orderBy(F.desc("__day"))) - F.col("n")
    return (
        per_day.withColumn("newer", newer)
        .filter((F.col("newer") < cap) & (F.col("newer") + F.col("n") >= cap))
        .select("status", F.col("__day").alias("__cut"), (F.lit(cap) - F.col("newer")).alias("__quota"), F.ceil(F.sqrt(F.col("n") / cap)).alias("__shares"))
    )


def _newest(rows: DataFrame, columns: list[str], cap: int) -> DataFrame:
    order: list[Column] = [F.desc_nulls_last("transaction_date")]
    order += [F.asc_nulls_last(c) for c in ("transaction_id", *columns) if c != "transaction_date"]
    share = F.pmod(F.xxhash64("transaction_id", "customer_id", "product_id", "amount"), F.col("__shares"))
    shares, final = (Window.partitionBy(*keys).orderBy(*order) for keys in (("status", "__share"), ("status",)))
    survivors = rows.withColumn("__share", share).withColumn("__rank", F.row_number().over(shares)).filter(F.col("__rank") <= cap)
    ranked = survivors.withColumn("__rank", F.row_number().over(final)).filter(F.col("__rank") <= cap)
    return ranked.filter(F.col("__rank") <= F.col("__quota"))
