"""Name contracts of the feeds and what happens when one is broken."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)


class ContractError(ValueError):
    """A feed lacks required columns or keys."""


def _names(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")


def column_report(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: valid, missing_columns, extra_columns, record_count."""
    missing = [name for name in required if name not in df.columns]
    extra = [name for name in df.columns if name not in required]
    return df.agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(not missing).alias("valid"),
        _names(missing).alias("missing_columns"),
        _names(extra).alias("extra_columns"),
        "record_count",
    )


def key_report(df: DataFrame, json: str, required: Sequence[str]) -> DataFrame:
    """S6 over all records: per required key, how many records lack it."""
    present = F.map_keys(F.from_json(json, "map<string,string>"))
    counts = df.select(present.alias("keys")).agg(
        F.count(F.lit(1)).alias("record_count"),
        *[F.count(F.when(F.array_contains("keys", key), 1)).alias(f"has_{i}") for i, key in enumerate(required)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(key).alias("required_key"),
                F.col("record_count"),
                (F.col("record_count") - F.col(f"has_{i}")).alias("missing_count"),
            )
            for i, key in enumerate(required)
        ]
    )
    return counts.select(F.inline(rows))


def first_record_report(df: DataFrame, json: str, required: Sequence[str], order: Column) -> DataFrame:
    """S6 as a quick look: only the first record in `order` is checked.

    One row: valid, missing_keys, record_count. No record at all is invalid.
    """
    keys = F.map_keys(F.from_json(F.min_by(json, order), "map<string,string>"))
    lacking = F.array_except(_names(required), F.coalesce(keys, F.array().cast("array<string>")))
    return df.agg(lacking.alias("missing_keys"), F.count(F.lit(1)).alias("record_count")).select(
        ((F.size("missing_keys") == 0) & (F.col("record_count") > 0)).alias("valid"), "missing_keys", "record_count"
    )


def require_columns(df: DataFrame, required: Sequence[str], feed: str, on_violation: str) -> None:
    """S7 from the column names alone, without reading any row."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        violated(f"{feed}: missing columns: {', '.join(missing)}", on_violation)


def require_keys(seen: dict, required: Sequence[str], feed: str, on_violation: str) -> None:
    """S6, S7 from counts of the delivered records (`documents.delivered`): no record may lack a required key.

    A feed without any record is not valid either.
    """
    if not seen["n"]:
        violated(f"{feed}: no records", on_violation)
    missing = [f"{key} ({seen[f'missing_{i}']} of {seen['n']})" for i, key in enumerate(required) if seen[f"missing_{i}"]]
    if missing:
        violated(f"{feed}: records lack {', '.join(missing)}", on_violation)


def violated(message: str, on_violation: str) -> None:
    if on_violation == "raise":
        raise ContractError(message)
    logger.warning(message)


def enforce(report: DataFrame, feed: str, on_violation: str) -> int:
    """Raise or warn when the one-row report is not valid; returns the record count."""
    row = report.first()
    if not row["valid"]:
        violated(f"{feed}: contract not met: {row.asDict()}", on_violation)
    return row["record_count"]
