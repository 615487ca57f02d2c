"""Lookups of dimension columns that stay balanced when one key is hot.

`attach` picks between two exact plans by the measured size of the dimension:

* at most `spark.sql.autoBroadcastJoinThreshold` bytes: broadcast;
* beyond it: a shuffle join in which every hot key is spread over as many
  salts as it has shares of `HOT_SHARE`. Only the dimension rows of hot keys are
  repeated, once per salt, so at most 2/HOT_SHARE rows are added whatever the
  data. The rows themselves are evaluated once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketwork.session import checkpointed

HOT_SHARE = 1e-5
MIN_HOT_ROWS = 1_000_000  # a key with fewer rows fits one task anyway
NULL_SALTS = 1_000


def column_bytes(df: DataFrame) -> dict[str, int]:
    """Uncompressed bytes of each column, in one aggregate over the table."""

    def size(field: T.StructField):
        if isinstance(field.dataType, T.StringType):
            return F.sum(F.coalesce(F.octet_length(field.name), F.lit(0)) + 16)
        return F.count(F.lit(1)) * 16

    row = df.agg(*[size(f).cast("bigint").alias(f.name) for f in df.schema.fields]).first()
    return {name: int(value or 0) for name, value in row.asDict().items()}


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own broadcast threshold in bytes; -1 means never."""
    value = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    units = {"kb": 2**10, "mb": 2**20, "gb": 2**30, "k": 2**10, "m": 2**20, "g": 2**30, "b": 1}
    for unit, factor in units.items():
        if value.endswith(unit):
            return int(value[: -len(unit)]) * factor
    return int(value)


def attach(
    rows: DataFrame,
    dim: DataFrame,
    key: str,
    how: str,
    dim_bytes: int,
    salt_on: str,
    counted: DataFrame | None = None,
    share: float = HOT_SHARE,
    min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Join `rows` to a dimension with unique `key`; `how` is inner, left or left_semi.

    `dim_bytes` is the measured size of `dim` (see `column_bytes`). `salt_on` is
    a column of `rows` with many values, read only when keys are salted. Hot keys
    are counted in `counted`, by default in `rows`; pass the stored table that
    `rows` derive from to avoid computing them for the count.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join type: {how}")
    if dim_bytes <= broadcast_limit(rows.sparkSession):
        return rows.join(F.broadcast(dim), key, how)
    hot = checkpointed(hot_keys(rows if counted is None else counted, key, share, min_rows))
    salts = F.coalesce("__salts", F.lit(1))
    # null keys match nothing, so they are spread without asking for their number
    spread = F.when(F.col(key).isNull(), F.lit(NULL_SALTS)).otherwise(salts)
    left = (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn("__salt", F.pmod(F.xxhash64(salt_on), spread).cast("int"))
        .drop("__salts")
    )
    right = (
        dim.join(F.broadcast(hot), key, "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("__salts")
    )
    return left.join(right, [key, "__salt"], how).drop("__salt")


def hot_keys(rows: DataFrame, key: str, share: float = HOT_SHARE, min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Keys with more than `share` of all rows (fewer than 1/share), and their salts.

    One salt stands for one share, so the salts of all keys are fewer than
    2/share. The count combines on the map side: a hot key is one row per task.
    """
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.select(F.sum("__n")).scalar()
    part = F.greatest(F.lit(float(min_rows)), total * F.lit(share))
    return counts.filter(F.col("__n") > part).select(key, F.ceil(F.col("__n") / part).cast("int").alias("__salts"))


def matched_counts(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows per key value on both sides of a foreign key.

    One line per key with `n_rows` and `n_dim` (null where absent). Both sides
    are counted before they meet, so a hot key is one row by then.
    """
    left = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    right = dim.groupBy(key).agg(F.count(F.lit(1)).alias("n_dim"))
    return left.join(right, key, "full_outer")


def matched_keys(rows: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """`matched_counts` of several foreign keys in one pass over `rows`: a line per `dimension` and key value.

    Each row becomes one narrow row per key, which is counted on the map side.
    """
    tagged = F.array(*[F.struct(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("key")) for name, (_, key) in dims.items()])
    left = rows.select(F.inline(tagged)).groupBy("dimension", "key").agg(F.count(F.lit(1)).alias("n_rows"))
    keys = [df.select(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("key")) for name, (df, key) in dims.items()]
    right = reduce(DataFrame.unionByName, keys).groupBy("dimension", "key").agg(F.count(F.lit(1)).alias("n_dim"))
    return left.join(right, ["dimension", "key"], "full_outer")


def first_per_key(df: DataFrame, key: str, order: Sequence, within: Sequence[str] = ()) -> DataFrame:
    """The first row of each key in a total order.

    Spark keeps one row per key in each task before the shuffle
    (WindowGroupLimit), so a hot key does not pile up in one task. `within` names columns that the key
    determines, such as the order of a sale: rows that are already dealt out by them are not shuffled again.
    """
    rank = F.row_number().over(Window.partitionBy(*within, key).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def last_before(rows: DataFrame, day: str, snapshots: DataFrame, taken: str) -> DataFrame:
    """As-of join: each row with the columns of the last snapshot taken before its day, null where there is none.

    `snapshots` has at most one row per day. A snapshot holds from the day after it to the next one's day; these spans
    meet the rows on the months they touch, so the join is an equality on months, and the calendar bounds the spans.
    """
    order = Window.orderBy(taken)  # one row per day
    spans = snapshots.withColumn("__until", F.coalesce(F.lead(taken).over(order), F.lit("9999-12-31").cast("date")))
    last = rows.select(F.max(day)).scalar()
    ends = F.least("__until", F.greatest(last, F.col(taken)))
    months = F.explode(F.sequence(F.trunc(taken, "MM"), F.trunc(ends, "MM"), F.expr("interval 1 month")))
    touched = spans.withColumn("__month", months)
    left = rows.withColumn("__month", F.trunc(day, "MM"))
    held = (left["__month"] == touched["__month"]) & (F.col(taken) < F.col(day)) & (F.col(day) <= F.col("__until"))
    return left.join(touched, held, "left").drop("__month", "__until")
