"""The layout of the fact: folders, the curve through its key columns, and what readers skip."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from basketwork.plans.warehouse import sample_warehouse
from basketwork.sources import layout, tables
from basketwork.sources.layout import Layout


def brute_place(ranks: list[int], bits: int) -> int:
    return int("".join(format(r, f"0{bits}b")[i] for i in range(bits) for r in ranks), 2)


def test_curve_interleaves_ranks(spark):
    rows = spark.createDataFrame([(a, b) for a in range(0, 64, 7) for b in range(0, 64, 5)], "a int, b int")
    got = rows.select("a", "b", layout.interleaved([F.col("a"), F.col("b")], 6).alias("p")).collect()
    assert all(r.p == brute_place([r.a, r.b], 6) for r in got)


def test_ranks_cut_keys_into_even_ranges(spark):
    keys = spark.range(10_000).select(F.col("id").cast("string").alias("k"))
    bounds = layout.range_bounds(keys, "k", 16)
    assert bounds == sorted(bounds) and len(bounds) == 15
    counts = keys.groupBy(layout.range_rank(F.col("k"), bounds).alias("r")).count().collect()
    assert len(counts) == 16 and max(r["count"] for r in counts) < 2 * min(r["count"] for r in counts)
    values = ["", "0", bounds[3], bounds[3] + "0", "zzz", None]
    ranks = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(layout.range_rank(F.col("v"), bounds)).collect()]
    assert ranks == [sum(b <= v for b in bounds) if v is not None else 0 for v in values]


def test_no_keys_and_equal_keys(spark):
    empty = spark.createDataFrame([], "k string")
    assert layout.range_bounds(empty, "k", 8) == []
    same = spark.range(100).select(F.lit("x").alias("k"))
    assert layout.range_bounds(same, "k", 8) == ["x"]


@pytest.mark.parametrize("bad", [{"folder": "week"}, {"slices": 0}, {"bits": 11}])
def test_unknown_layouts_are_refused(bad):
    with pytest.raises(ValueError):
        Layout(**bad)


def sales(spark, n: int = 40_000):
    key = lambda c, k: F.pmod(F.xxhash64("id", F.lit(c)), F.lit(k)).cast("string")
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), F.pmod(F.col("id"), F.lit(60)).cast("int"))
    return spark.range(n).select(
        F.col("id").cast("string").alias("transaction_id"), key("c", 900).alias("customer_id"), key("p", 700).alias("product_id"), day.alias("transaction_date"),
    )


def groups_read(path: str, column: str, value: str) -> tuple[int, int]:
    """Row groups whose statistics admit a value, and all."""
    read = whole = 0
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            whole += 1
            read += s.min <= value <= s.max
    return read, whole


def test_either_key_skips_most_row_groups(spark, tmp_path):
    df = sales(spark)
    plain, curved = str(tmp_path / "plain"), str(tmp_path / "curved")
    # the same number of files, dealt by customer alone
    df.withColumn(layout.MONTH_COLUMN, F.date_format("transaction_date", "yyyy-MM")).repartitionByRange(32, "customer_id", "product_id").write.partitionBy(layout.MONTH_COLUMN).parquet(plain)
    # as with data of many times the size: slices are not gathered in one task
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "211"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    tables.write_fact(df, curved, Layout("month", slices=32))
    for k, v in before.items():
        spark.conf.set(k, v)
    for column in ("customer_id", "product_id"):
        read, whole = groups_read(curved, column, "555")
        assert whole >= 32 and read * 2 < whole, (column, read, whole)
    by_product, whole = groups_read(plain, "product_id", "555")
    assert by_product == whole  # a sort by customer skips nothing for a product
    for column in ("customer_id", "product_id"):
        rows = tables.stored_fact(spark, curved).filter(F.col(column) == "555")
        assert rows.count() == df.filter(F.col(column) == "555").count()
        assert f"EqualTo({column},555)" in rows._jdf.queryExecution().executedPlan().toString()


def test_months_hold_the_same_rows_and_are_replaced_alone(spark, tmp_path):
    df, path = sales(spark, 2000), str(tmp_path / "fact")
    tables.write_fact(df, path, Layout("month"))
    assert {p for p in os.listdir(path) if "=" in p} == {"sales_month=2024-01", "sales_month=2024-02"}
    read = tables.stored_fact(spark, path)
    assert sorted(read.columns) == sorted(df.columns) and read.exceptAll(df.select(read.columns)).isEmpty() and read.count() == 2000
    march = df.filter("transaction_date < '2024-02-01'").limit(10)
    tables.replace_days(march, path, Layout("month"))
    assert tables.stored_fact(spark, path).filter("transaction_date < '2024-02-01'").count() == 10
    assert tables.stored_fact(spark, path).filter("transaction_date >= '2024-02-01'").count() == df.filter("transaction_date >= '2024-02-01'").count()


@pytest.mark.skipif(not DATA.exists(), reason="sample tables not present")
def test_sample_fact_has_few_files(spark):
    files = sample_warehouse(spark, str(DATA)).sales.inputFiles()
    assert len(files) < 120
