"""How a fact lies on disk: folders of days or months, and inside them slices of a space-filling curve.

A sort by one column lets a reader skip row groups for that column alone. The curve interleaves the bits of the range
ranks of several columns, so that near rows on it are near in all of them, and a filter on any of them skips most slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_COLUMN, MONTH_COLUMN = "transaction_date", "sales_month"
SAMPLE_KEYS = 20_000


@dataclass(frozen=True)
class Layout:
    """One setting for a table, whatever its size.

    `folder`: "day", which a reader can prune by name, or "month" for a fact whose days are far smaller than a file;
    rows are sorted by day in both, so row groups are skipped by date. `slices`: 1, or how many parts of the curve
    each folder is dealt into; choose it so that a slice of a folder is a few row groups. `bits`: ranks per column
    as a power of two; with all columns together the curve has 2 ** (bits * columns) places.
    """

    folder: str = "day"
    slices: int = 1
    bits: int = 6

    def __post_init__(self) -> None:
        if self.folder not in ("day", "month") or not 1 <= self.bits <= 10 or self.slices < 1:
            raise ValueError(f"no such layout: {self}")

    @property
    def column(self) -> str:
        return DAY_COLUMN if self.folder == "day" else MONTH_COLUMN

    def with_folder(self, df: DataFrame) -> DataFrame:
        return df if self.folder == "day" else df.withColumn(MONTH_COLUMN, F.date_format(DAY_COLUMN, "yyyy-MM"))


def range_bounds(keys: DataFrame, column: str, ranges: int) -> list:
    """At most `ranges` - 1 values that cut a column into ranges of about equal size.

    They come from the `SAMPLE_KEYS` rows of smallest hash, a uniform sample that each task limits itself.
    Bounds shape files only; no result depends on them.
    """
    rows = keys.select(F.col(column).alias("v")).filter("v IS NOT NULL")
    sample = sorted(r.v for r in rows.orderBy(F.xxhash64("v"), "v").limit(SAMPLE_KEYS).collect())
    return sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []


def range_rank(value: Column, bounds: Sequence) -> Column:
    """How many bounds are at most `value`, by a balanced tree of comparisons; null ranks first."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(bounds[middle]), tree(low, middle)).otherwise(tree(middle + 1, high))

    return F.when(value.isNull(), 0).otherwise(tree(0, len(bounds))).cast("int")


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """Place on the curve: bit i of each rank in turn, from the highest."""
    place = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for rank in ranks:
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long"))
    return place


def curve(df: DataFrame, columns: Sequence[str], bits: int, keys: Mapping[str, DataFrame] | None = None) -> Column:
    """Place of each row of `df` on the curve through `columns`.

    `keys` holds for each column the frame that its range bounds are taken from, such as the dimension, so that the
    rows themselves need not be computed for them; by default `df`.
    """
    ranks = [range_rank(F.col(c), range_bounds((keys or {}).get(c, df), c, 1 << bits)) for c in columns]
    return interleaved(ranks, bits)
