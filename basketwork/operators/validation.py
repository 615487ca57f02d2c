"""Warehouse validation queries and pipeline gates.

Foreign-key figures come from counts per key (`joins.matched_counts`): one
small row per key value reaches the join, not every sale.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketwork.functions.numbers import count_if, mean, percent
from basketwork.operators.analytics import DIRECT, by_country_category_channel, monthly_sales
from basketwork.operators.joins import matched_counts
from basketwork.operators.star import NO_CAMPAIGN
from basketwork.operators.warehouse import KEYS, Warehouse
from basketwork.sources.registry import missing

# Date limits and sizes of the validation reports.
REPORT_SINCE = dt.date(2024, 1, 1)
OLD_BEFORE = dt.date(2020, 1, 1)
TOP_COUNTRIES = 10
MIN_GROUP_SALES = 10
TOP_GROUPS = 20


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("bigint")


def table_listing(spark: SparkSession, path: str) -> DataFrame:
    """V1: row count and stored bytes of each warehouse table."""
    rows = []
    for name in KEYS:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{path}/{name}")
        counted = spark.read.parquet(f"{path}/{name}").agg(F.count(F.lit(1)).alias("row_count"))
        size = files.filter(F.col("path").endswith(".parquet")).select(F.sum("length")).scalar()
        rows.append(counted.select(F.lit(name).alias("table_name"), "row_count", size.alias("size_bytes")))
    return reduce(DataFrame.unionByName, rows).orderBy("table_name")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("table_name"), "record_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows).orderBy("table_name")


def schema_listing(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """V3: columns of each table in order."""
    rows = [
        (name, i, field.name, field.dataType.simpleString())
        for name, df in tables.items()
        for i, field in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")


def foreign_key(w: Warehouse, table: str, valid: str, pct: str) -> DataFrame:
    """V4, V5: sales whose key exists in the dimension, and their share."""
    pairs = matched_counts(w.sales, w.tables[table], KEYS[table])
    total = F.sum(F.col("n_rows") * F.coalesce("n_dim", F.lit(1)))
    found = F.sum(F.col("n_rows") * F.col("n_dim"))
    return pairs.agg(_zero(total).alias("total_transactions"), _zero(found).alias(valid)).select(
        "*", percent(F.col(valid), F.col("total_transactions")).alias(pct)
    )


def customer_and_product_keys(w: Warehouse) -> DataFrame:
    """V4 and V5 side by side, one row per foreign key."""
    rows = [
        foreign_key(w, name, "valid_refs", "integrity_pct").select(F.lit(KEYS[name]).alias("foreign_key"), "*")
        for name in ("dim_customers", "dim_products")
    ]
    return rows[0].unionByName(rows[1])


def campaign_key(w: Warehouse) -> DataFrame:
    """V6: as V4 for campaigns, where NO_CAMPAIGN counts as valid."""
    pairs = matched_counts(w.sales, w.campaigns, "campaign_id")
    rows = F.col("n_rows") * F.coalesce("n_dim", F.lit(1))
    without = F.col("campaign_id") == NO_CAMPAIGN
    return pairs.agg(
        _zero(F.sum(rows)).alias("total_transactions"),
        _zero(F.sum(F.when(F.col("n_dim").isNotNull() | without, rows))).alias("valid_campaign_refs"),
        _zero(F.sum(F.when(without, rows))).alias("no_campaign_count"),
    ).select(
        "total_transactions",
        "valid_campaign_refs",
        percent(F.col("valid_campaign_refs"), F.col("total_transactions")).alias("campaign_integrity_pct"),
        "no_campaign_count",
    )


def orphans(w: Warehouse) -> DataFrame:
    """V7: sales without dimension row per foreign key."""
    rows = []
    for name, issue in (
        ("dim_customers", "orphaned_customers"),
        ("dim_products", "orphaned_products"),
        ("dim_campaigns", "orphaned_campaigns"),
    ):
        lost = matched_counts(w.sales, w.tables[name], KEYS[name]).filter(F.col("n_dim").isNull())
        if name == "dim_campaigns":
            lost = lost.filter(F.col("campaign_id") != NO_CAMPAIGN)
        rows.append(lost.agg(_zero(F.sum("n_rows")).alias("count")).select(F.lit(issue).alias("issue"), "count"))
    return reduce(DataFrame.unionByName, rows)


def key_uniqueness(w: Warehouse) -> DataFrame:
    """V8: rows against distinct keys per table."""
    rows = []
    for name, df in w.tables.items():
        per_key = df.groupBy(KEYS[name]).agg(F.count(F.lit(1)).alias("n"))
        totals = per_key.agg(_zero(F.sum("n")).alias("total_records"), F.count(KEYS[name]).alias("unique_ids"))
        same = F.col("total_records") == F.col("unique_ids")
        rows.append(
            totals.select(
                F.lit(name).alias("table_name"), "*", F.when(same, "PASS").otherwise("FAIL").alias("uniqueness_check")
            )
        )
    return reduce(DataFrame.unionByName, rows)


def _filled(name: str) -> Column:
    return count_if(F.col(name) != "")


def field_completeness(w: Warehouse) -> DataFrame:
    """V9: filled shares; the product row is united by position.

    So the product name, category and price stand under the customer columns
    first name, email and country.
    """
    n = F.count(F.lit(1))
    people = w.customers.agg(
        percent(_filled("first_name"), n).alias("first_name_completeness"),
        percent(_filled("email"), n).alias("email_completeness"),
        percent(_filled("country"), n).alias("country_completeness"),
    ).select(F.lit("dim_customers").alias("table_name"), "*")
    goods = w.products.agg(
        percent(_filled("name"), n).alias("name_completeness"),
        percent(_filled("category"), n).alias("category_completeness"),
        percent(count_if(F.col("price") > 0), n).alias("price_completeness"),
    ).select(F.lit("dim_products").alias("table_name"), "*")
    return people.union(goods)


def required_nulls(w: Warehouse) -> DataFrame:
    """Missing keys, dates and amounts of the fact."""
    c = F.col
    return w.sales.agg(
        count_if(c("customer_id").isNull()).alias("null_customer_ids"),
        count_if(c("product_id").isNull()).alias("null_product_ids"),
        count_if(c("amount").isNull() | (c("amount") <= 0)).alias("null_or_zero_amounts"),
        count_if(c("transaction_date").isNull()).alias("null_transaction_dates"),
    ).select(F.lit("fact_transactions_nulls").alias("check_type"), "*")


def date_range(w: Warehouse, as_of: dt.date, old_before: dt.date = OLD_BEFORE) -> DataFrame:
    """First and last sale, sales before a date and in the future."""
    day = F.col("transaction_date")
    return w.sales.agg(
        F.min(day).alias("earliest_transaction"),
        F.max(day).alias("latest_transaction"),
        count_if(day < F.lit(old_before)).alias("dates_before_2020"),
        count_if(day > F.lit(as_of)).alias("future_dates"),
    ).select(F.lit("date_validation").alias("check_type"), "*")


def _sales_by_country(w: Warehouse) -> DataFrame:
    per_customer = w.sales.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("revenue"))
    placed = w.customers.select("customer_id", "country").join(per_customer, "customer_id")
    return placed.groupBy("country").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("n").alias("n"), F.sum("revenue").alias("revenue")
    )


def revenue_by_country(w: Warehouse, top: int | None = TOP_COUNTRIES) -> DataFrame:
    """Countries by revenue."""
    return (
        _sales_by_country(w)
        .select(
            "country",
            F.col("n").alias("transaction_count"),
            F.col("revenue").cast("double").alias("total_revenue"),
            mean(F.col("revenue"), F.col("n")).alias("avg_transaction_value"),
        )
        .orderBy(F.desc("total_revenue"), "country")
        .transform(lambda rows: rows if top is None else rows.limit(top))
    )


def multi_dimensional(
    w: Warehouse,
    since: dt.date = REPORT_SINCE,
    more_than: int = MIN_GROUP_SALES,
    top: int | None = TOP_GROUPS,
) -> DataFrame:
    """Category x country x channel; sales without campaign keep a null channel."""
    n, revenue = F.col("n"), F.col("revenue")
    return (
        by_country_category_channel(w, since)
        .filter(n > more_than)
        .select(
            "category",
            "country",
            "channel",
            n.alias("transaction_count"),
            revenue.cast("double").alias("total_revenue"),
            mean(revenue, n).alias("avg_transaction_value"),
        )
        .orderBy(F.desc("total_revenue"), "category", "country", F.coalesce("channel", F.lit(DIRECT)))
        .transform(lambda rows: rows if top is None else rows.limit(top))
    )


def monthly_revenue(w: Warehouse, since: dt.date = REPORT_SINCE) -> DataFrame:
    """Months from the newest."""
    return (
        monthly_sales(w, since)
        .select(
            "month",
            F.col("n").alias("transaction_count"),
            F.col("revenue").cast("double").alias("monthly_revenue"),
            F.col("customers").alias("unique_customers"),
        )
        .orderBy(F.desc("month"))
    )


def summary(w: Warehouse, as_of: dt.datetime | None = None) -> DataFrame:
    """One row of table counts and total revenue."""

    def rows(df: DataFrame) -> Column:
        return df.select(F.count(F.lit(1))).scalar()

    sales = w.sales.agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("revenue"))
    return sales.select(
        F.lit("VALIDATION_SUMMARY").alias("report_type"),
        (F.current_timestamp() if as_of is None else F.lit(as_of)).alias("validation_timestamp"),
        rows(w.customers).alias("customer_count"),
        rows(w.products).alias("product_count"),
        rows(w.campaigns).alias("campaign_count"),
        F.col("n").alias("transaction_count"),
        F.col("revenue").cast("double").alias("total_revenue"),
    )


def country_kpis(w: Warehouse, top: int | None = TOP_COUNTRIES) -> DataFrame:
    """Buyers, revenue and mean order value per country."""
    return (
        _sales_by_country(w)
        .select(
            "country",
            "customers",
            F.col("revenue").cast("double").alias("total_revenue"),
            mean(F.col("revenue"), F.col("n")).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), "country")
        .transform(lambda rows: rows if top is None else rows.limit(top))
    )


def category_revenue(w: Warehouse) -> DataFrame:
    """Revenue and sales per category."""
    per_product = w.sales.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("revenue"))
    return (
        w.products.select("product_id", "category")
        .join(per_product, "product_id")
        .groupBy("category")
        .agg(F.sum("revenue").cast("double").alias("revenue"), F.sum("n").alias("transactions"))
        .orderBy(F.desc("revenue"), "category")
    )


class GateError(RuntimeError):
    """A pipeline gate did not hold."""


def require_folders(spark: SparkSession, folders: list[str]) -> None:
    """Every folder holds data, else raise."""
    from basketwork.sources.tables import path_exists

    missing = [folder for folder in folders if not path_exists(spark, folder)]
    if missing:
        raise GateError(f"required data not found: {', '.join(missing)}")


def existence(spark: SparkSession, names: list[str]) -> DataFrame:
    """table_name, table_exists and record_count (null for what is missing) of catalogue entries."""
    absent = missing(spark, names)
    rows = [
        spark.table(name).agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name.split(".")[-1]).alias("table_name"), F.lit(True).alias("table_exists"), "record_count")
        for name in names if name not in absent
    ]
    gone = [(name.split(".")[-1], False, None) for name in absent]
    return reduce(DataFrame.unionByName, [*rows, spark.createDataFrame(gone, "table_name string, table_exists boolean, record_count long")])


def require_tables(spark: SparkSession, names: list[str]) -> None:
    """Every name is a table or view of the catalogue, else raise."""
    if absent := missing(spark, names):
        raise GateError(f"required tables not found: {', '.join(absent)}")


def require_rows(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Counts per table; raises when a table is unreadable or all are empty."""
    try:
        counts = {r["table_name"]: r["record_count"] for r in table_counts(tables).collect()}
    except Exception as error:
        raise GateError(f"tables not readable: {error}") from error
    if sum(counts.values()) == 0:
        raise GateError("no records in any table")
    return counts
