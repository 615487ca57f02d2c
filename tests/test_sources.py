from __future__ import annotations

import datetime as dt
import json
import os
import time

import pytest
from conftest import rows_by
from pyspark.sql import functions as F

from basketwork import schemas
from basketwork.plans import catalogue
from basketwork.sources import contracts, documents, lake, tables

AT = dt.datetime(2024, 6, 30, 12)
HEADER = "customer_id,age,first_name\n"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return path


def test_newest_customer_file_wins(spark, tmp_path):
    old = write(tmp_path / "synthetic_customers_2.csv", HEADER + "1,20,ann\n")
    write(tmp_path / "other.csv", HEADER + "9,9,no\n")
    new = write(tmp_path / "synthetic_customers_1.csv", HEADER + '2,x," b, ""c"" "\n3,,""\n')
    now = time.time()
    os.utime(old, (now - 100, now - 100))
    os.utime(new, (now, now))
    out = rows_by(lake.read_latest_customers(spark, str(tmp_path)), "customer_id")
    assert set(out) == {"2", "3"} and out["2"].source_file == "synthetic_customers_1.csv"
    assert out["2"].first_name == ' b, "c" ' and out["2"].age is None and out["3"].first_name is None


def test_csv_columns_follow_their_names(spark, tmp_path):
    path = write(tmp_path / "c.csv", "age,extra,customer_id\n41,e,7\n")
    df = lake.read_csv(spark, str(path), schemas.CUSTOMERS)
    assert df.columns == ["age", "extra", "customer_id"] and df.first().asDict() == {"age": 41, "extra": "e", "customer_id": "7"}


def test_no_customer_file(spark, tmp_path):
    write(tmp_path / "synthetic_products_1.csv", HEADER)
    with pytest.raises(Exception):
        lake.read_latest_customers(spark, str(tmp_path))


def page(n, ids, has_next, status="success"):
    return {"page": n, "status": status, "data": [{"product_id": i} for i in ids], "pagination": {"has_next": has_next}}


def pages(spark, tmp_path, *items):
    path = write(tmp_path / "pages.json", "\n".join(json.dumps(i) for i in items))
    return documents.read_pages(spark, str(path))


def ids(df):
    return sorted(r.product_id for r in df.collect())


def test_pages_stop_at_the_last_one(spark, tmp_path):
    df = pages(spark, tmp_path, page(3, "e", True), page(1, "ab", True), page(2, "cd", False))
    assert ids(documents.products_from_pages(df)) == ["a", "b", "c", "d"]


def test_pages_stop_at_an_empty_one(spark, tmp_path):
    df = pages(spark, tmp_path, page(1, "a", True), page(2, "", True), page(3, "b", True))
    assert ids(documents.products_from_pages(df)) == ["a"]


def test_page_without_pagination_is_the_last(spark, tmp_path):
    df = pages(spark, tmp_path, {"page": 1, "status": "success", "data": [{"product_id": "a"}]}, page(2, "b", False))
    assert ids(documents.products_from_pages(df)) == ["a"]


def test_error_pages(spark, tmp_path):
    with pytest.raises(documents.PageError, match="page 2"):
        documents.products_from_pages(pages(spark, tmp_path, page(1, "a", True), page(2, "b", False, "error")))
    after = pages(spark, tmp_path, page(1, "a", False), page(2, "b", True, "error"))
    assert ids(documents.products_from_pages(after)) == ["a"]


def test_campaign_documents(feed):
    rows = [
        {"document_id": "1", "status": None},
        {"document_id": "2", "status": "B", "start_date": dt.datetime(2024, 1, 1)},
        {"document_id": "3", "status": "B", "start_date": dt.datetime(2024, 2, 1)},
        {"document_id": "4", "status": ""},
    ]
    out = documents.campaign_documents(feed("marketing_campaigns", *rows))
    assert [r.document_id for r in out.collect()] == ["4", "3", "2"]
    assert lake.iso_timestamps(out).collect()[1].start_date == "2024-02-01T00:00:00.000000"


def sale(i, status, day, hour=0):
    return {"transaction_id": f"{status}{i}", "status": status,
            "transaction_date": None if day is None else dt.datetime(2024, 1, day, hour)}


def test_newest_sales_per_status(feed):
    rows = [sale(i, "completed", 1 + i // 4, i % 4) for i in range(12)]
    rows += [sale(i, "pending", None) for i in range(12)]
    rows += [sale(i, "cancelled", 1) for i in range(3)] + [sale(0, "refunded", 2), sale(0, "COMPLETED", 2)]
    docs = feed("sales_transactions", *rows)
    out = documents.sale_documents(docs, cap=10)
    counts = {r["status"]: r["count"] for r in out.groupBy("status").count().collect()}
    assert counts == {"completed": 10, "pending": 10, "cancelled": 3}
    kept = {r.transaction_id for r in out.collect()}
    assert not {"completed0", "completed1"} & kept
    assert documents.sale_documents(docs).count() == 27


@pytest.mark.parametrize("cap", [None, 2])
def test_sales_come_newest_first_per_status(spark, feed, tmp_path, cap):
    days = {"pending": [3, None, 9, 9], "cancelled": [1, 5], "completed": [2, None, 8], "refunded": [7]}
    rows = [sale(i, status, day) for status, found in days.items() for i, day in enumerate(found)]
    feed("sales_transactions", *rows).repartition(4).write.json(str(tmp_path / "sales"))
    out = catalogue._sale_documents(spark, {"sales_transactions": str(tmp_path / "sales")}, cap).collect()
    expected = ["completed2", "completed0", "completed1", "pending2", "pending3", "pending0", "pending1", "cancelled1", "cancelled0"]
    dated = {"completed1", "pending0", "pending1"}
    assert [r.transaction_id for r in out] == [i for i in expected if cap is None or i not in dated]


@pytest.mark.parametrize("cap", [1, 7, 50, 199, 200, 500])
def test_newest_sales_match_a_full_sort(spark, feed, cap):
    """A third of the sales fall on one day of one status."""
    rows = [sale(i, "completed", 5 if i % 3 == 0 else 1 + i * 7 % 28, i % 24) for i in range(200)]
    docs = feed("sales_transactions", *rows).repartition(5)
    out = [r.transaction_id for r in documents.sale_documents(docs, cap=cap).collect()]
    expected = sorted(rows, key=lambda r: (-r["transaction_date"].timestamp(), r["transaction_id"]))[:cap]
    assert sorted(out) == sorted(r["transaction_id"] for r in expected)


def test_a_cap_that_ends_with_a_day(feed):
    docs = feed("sales_transactions", *[sale(i, "pending", 1 + i // 4) for i in range(12)])
    for cap in (4, 8):
        kept = {r.transaction_id for r in documents.sale_documents(docs, cap=cap).collect()}
        assert kept == {f"pending{i}" for i in range(12 - cap, 12)}


def test_null_campaigns_become_empty(feed):
    rows = [{"transaction_id": str(i), "campaign_id": c} for i, c in enumerate([None, "", "m"])]
    out = documents.fill_campaign(feed("sales_transactions", *rows)).collect()
    assert [r.campaign_id for r in out] == ["", "", "m"]


def test_column_contract(spark):
    df = spark.createDataFrame([(1, 2)], "product_id int, extra int")
    row = contracts.column_report(df, schemas.REQUIRED["products"]).first()
    assert (row.valid, row.missing_columns, row.extra_columns, row.record_count) == (
        False, ["name", "category", "price"], ["extra"], 1,
    )
    with pytest.raises(contracts.ContractError):
        contracts.enforce(contracts.column_report(df, ["name"]), "products", "raise")
    assert contracts.enforce(contracts.column_report(df, ["name"]), "products", "warn") == 1
    assert contracts.enforce(contracts.column_report(df, ["extra"]), "products", "raise") == 1
    with pytest.raises(contracts.ContractError):
        contracts.require_columns(df, ["name"], "products", "raise")


def test_key_contract(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": null}'), (2, '{"a": {"c": 2}}')], "n int, doc string")
    first = contracts.first_record_report(df, "doc", ["a", "b"], F.col("n")).first()
    assert first.valid and first.record_count == 2
    missing = {r.required_key: r.missing_count for r in contracts.key_report(df, "doc", ["a", "b"]).collect()}
    assert missing == {"a": 0, "b": 1}
    empty = contracts.first_record_report(df.limit(0), "doc", ["a"], F.col("n")).first()
    assert not empty.valid and empty.missing_keys == ["a"]


def test_metadata_columns(feed):
    out = lake.with_metadata(feed("products", {"product_id": "1"}), "products", "catalogue", F.lit(AT)).first()
    assert (out.api_source, out.ingestion_timestamp, out.extraction_timestamp) == ("catalogue", AT, AT)


def test_csv_round_trip_keeps_blanks_and_quotes(spark, feed, tmp_path):
    rows = [{"customer_id": "1", "first_name": ' "a", b ', "last_name": "", "city": None}]
    path = lake.write_csv(feed("customers", *rows), str(tmp_path), "raw", "customers", AT)
    assert path.endswith("/raw/customers_20240630_120000.csv")
    out = lake.read_csv(spark, path, schemas.CUSTOMERS).first()
    assert (out.first_name, out.last_name, out.city, out.registration_date) == (' "a", b ', None, None, dt.date(2024, 1, 1))


def test_json_sink_listing_and_freshness(spark, feed, tmp_path):
    lake.write_json(feed("products", {"product_id": "1"}), str(tmp_path), "processed", "products", AT)
    write(tmp_path / "processed/.keep", "")
    names = [r["name"] for r in lake.list_layer(spark, str(tmp_path), "processed").collect()]
    assert names == ["products_20240630_120000.json"]
    row = lake.file_freshness(spark, str(tmp_path), "processed").first()
    assert row.fresh and row.latest_file.endswith(".json")
    later = F.current_timestamp() + F.expr("interval 25 hours")
    assert not lake.file_freshness(spark, str(tmp_path), "processed", later).first().fresh


def test_an_empty_layer_is_not_fresh(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    row = lake.file_freshness(spark, str(tmp_path), "raw").first()
    assert row.fresh is False and row.latest_file is None


def test_staging_modes_and_creation(spark, feed, tmp_path):
    df, path = feed("customers", {"customer_id": "1"}), str(tmp_path / "t")
    assert not tables.path_exists(spark, path)
    tables.create_if_absent(spark, path, schemas.CUSTOMERS)
    tables.create_if_absent(spark, path, schemas.CUSTOMERS)
    assert tables.stored(spark, path).count() == 0
    for mode, n in (("append", 1), ("append", 2), ("overwrite", 1)):
        tables.write_staging(df, path, mode)
        assert spark.read.parquet(path).count() == n


def test_fact_folders_by_day_and_day_overwrite(spark, warehouse, tmp_path):
    days = [dt.datetime(2024, 6, d) for d in (1, 1, 2)]
    w = warehouse([{"customer_id": "c"}], [{"product_id": "p"}], [], [{"transaction_date": d} for d in days])
    path = str(tmp_path / "fact")
    tables.write_fact(w.sales, path)
    assert {p for p in os.listdir(path) if "=" in p} == {"transaction_date=2024-06-01", "transaction_date=2024-06-02"}
    read = tables.stored(spark, path)
    assert read.filter("transaction_date = '2024-06-01'").count() == 2
    # one day replaced, then the whole fact: other days stay, then go
    tables.replace_days(w.sales.filter("transaction_date = '2024-06-01'").limit(1), path)
    assert tables.stored(spark, path).count() == 2
    tables.write_fact(w.sales.filter("transaction_date = '2024-06-02'"), path)
    assert tables.stored(spark, path).count() == 1


def test_a_hot_day_is_split_over_tasks(spark, tmp_path):
    keys = {c: F.lit("x") for c in tables.CLUSTERING[tables.FACT]}
    day = spark.range(200_000).withColumns({**keys, "v": F.sha2(F.col("id").cast("string"), 256), tables.PARTITION: F.to_date(F.lit("1900-01-01"))})
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        tables.write_fact(day.repartition(8), str(tmp_path / "hot"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size or "64m")
    files = [f for f in os.listdir(tmp_path / "hot" / "transaction_date=1900-01-01") if f.endswith(".parquet")]
    assert len(files) > 2 and tables.stored(spark, str(tmp_path / "hot")).count() == 200_000


def test_export(spark, tmp_path):
    assert tables.export_csv(spark.range(5), str(tmp_path / "all")) == 5
    assert tables.export_csv(spark.range(5), str(tmp_path / "some"), limit=2) == 2


def test_ingestion_events(spark, tmp_path):
    lake.log_ingestion(spark, str(tmp_path / "e"), "products", "raw", "FAILED", error="x", at=AT)
    row = spark.read.parquet(str(tmp_path / "e")).first()
    assert row.asDict() == {"timestamp": AT, "source": "products", "layer": "raw", "status": "FAILED", "record_count": 0, "error": "x"}
