"""Money, ratios and buckets.

Money is DECIMAL from the moment a feed is cleaned, so sums are exact and do
not depend on the order in which partitions are merged. Doubles appear only in
results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
PRICE = "decimal(18,6)"  # catalogue prices may pass through unrounded
WIDE = "decimal(20,2)"  # room for totals, leaves 14 digits for a quotient
RATE = "decimal(18,6)"


def money(value: Column) -> Column:
    """Rounded to cents; null and negative become 0.00."""
    return F.when(value >= 0, value.cast(MONEY)).otherwise(F.lit(0).cast(MONEY))


def non_negative(value: Column) -> Column:
    """Null and negative counts become 0."""
    return F.when(value >= 0, value).otherwise(F.lit(0).cast("bigint"))


def ratio(numerator: Column, denominator: Column, digits: int, times: int = 1, kind: str = WIDE) -> Column:
    """`times * numerator / denominator`, rounded; null on a zero denominator."""
    scaled = numerator.cast(kind) * F.lit(times)
    return F.round(scaled / F.nullif(denominator.cast(kind), F.lit(0).cast(kind)), digits).cast("double")


def percent(numerator: Column, denominator: Column, digits: int = 2, kind: str = WIDE) -> Column:
    return ratio(numerator, denominator, digits, times=100, kind=kind)


def mean(total: Column, count: Column) -> Column:
    """An unrounded mean as double; null when nothing was counted."""
    return total.cast("double") / F.nullif(count, F.lit(0)).cast("double")


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def first_match(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    """The value of the first rule that holds; a null condition does not."""
    (condition, value), *rest = rules
    case = F.when(condition, F.lit(value))
    for condition, value in rest:
        case = case.when(condition, F.lit(value))
    return case.otherwise(F.lit(default))
