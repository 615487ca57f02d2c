"""What is written and shuffled: compressed drops, sales shuffled once and narrow, no unpacked checkpoints in a stream."""

from __future__ import annotations

from pathlib import Path

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from basketwork.operators import star
from basketwork.plans import landing
from basketwork.sources import sample_feeds, tables
from basketwork.sources.layout import Layout
from basketwork.streaming import fact as fact_stream
from basketwork.streaming import transactions as stream


def test_drops_are_compressed_and_whole(spark, tmp_path):
    landed = landing.land(spark, str(DATA), str(tmp_path))
    files = [p.name for p in Path(tmp_path).rglob("part-*")]
    assert files and all(name.endswith(".gz") for name in files)
    assert spark.read.json(landed["sales_transactions"]).count() == sample_feeds.transactions(spark, str(DATA)).count()


@pytest.fixture
def shuffled(spark):
    """Joins are shuffled, as they are for feeds too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_sales_dealt_out_by_order_are_not_shuffled_again(spark, shuffled):
    feed = sample_feeds.transactions(spark, str(DATA), with_order=True)
    assert _exchanges(star.best_transactions(feed, star.FACT_SOURCES, [sample_feeds.ORDER])) == _exchanges(feed)
    plain = star.best_transactions(sample_feeds.transactions(spark, str(DATA))).select(*star.FACT_SOURCES)
    mine = star.best_transactions(feed, star.FACT_SOURCES, [sample_feeds.ORDER]).select(*star.FACT_SOURCES)
    assert sorted(map(str, mine.collect())) == sorted(map(str, plain.collect()))


def test_flags_of_keys_shuffle_keys_only(spark):
    feed, keys = sample_feeds.transactions(spark, str(DATA)), ["transaction_id", "customer_id", "product_id", "campaign_id"]
    narrow = star.best_transactions(feed, keys)
    assert set(narrow.columns) == {*keys, "status", "transaction_date"}
    plain = star.best_transactions(feed).select(*keys)
    assert sorted(map(str, narrow.select(*keys).collect())) == sorted(map(str, plain.collect()))


def test_derived_columns_come_after_the_shuffle(spark, tmp_path):
    best = star.best_transactions(sample_feeds.transactions(spark, str(DATA)))
    whole = star.clean_sales(best, F.lit("2024-01-01").cast("timestamp"))
    for layout in (Layout(), Layout("month"), Layout("month", slices=4)):
        path = f"{tmp_path}/{layout.folder}{layout.slices}"
        tables.write_fact(star.without_derived(whole), path, layout, derive=star.with_derived)
        stored = tables.stored_fact(spark, path)
        assert sorted(stored.columns) == sorted(whole.columns)
        assert sorted(map(str, stored.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_stream_keeps_no_checkpoint_of_versions(spark, feed, tmp_path, monkeypatch):
    for name, dim in (("dim_customers", star.dim_customers(feed("customers", {"customer_id": "c"}))), ("dim_products", star.dim_products(feed("products", {"product_id": "p"})))):
        tables.write_dimension(dim, name, f"{tmp_path}/{name}")
    target = fact_stream.Target(str(tmp_path), f"{tmp_path}/state")
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.checkpoint", lambda *a, **k: pytest.fail("rows stored unpacked"))
    for batch_id, amount in enumerate((10.0, 12.0)):
        fact_stream.merge_batch(feed("sales_transactions", {"transaction_id": "1", "amount": amount, "status": "COMPLETED"}), batch_id, target)
    assert [r.transaction_id for r in tables.stored_fact(spark, target.fact).collect()] == ["1"]


def test_streamed_sales_are_compressed_and_their_state_is_on_disk(spark, feed, tmp_path):
    source, staging, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    feed("sales_transactions", *[{"transaction_id": str(i % 5)} for i in range(20)]).write.json(source)
    settings = {key: spark.conf.get(key, None) for key in stream.STATE_SETTINGS}
    stream.load_stream(stream.first_deliveries(stream.read_stream(spark, source)), staging, state).awaitTermination()
    assert settings == {key: spark.conf.get(key, None) for key in stream.STATE_SETTINGS}
    assert spark.read.parquet(staging).count() == 5
    assert all(".zstd." in p.name for p in Path(staging).glob("part-*"))
    kept = {p.suffix for p in Path(state, "state").rglob("[0-9]*.*")}
    assert kept and ".delta" not in kept


def test_a_stream_begun_in_memory_goes_on_with_its_state(spark, feed, tmp_path, monkeypatch):
    source, staging, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def load(*ids):
        feed("sales_transactions", *[{"transaction_id": i} for i in ids]).write.mode("append").json(source)
        stream.load_stream(stream.first_deliveries(stream.read_stream(spark, source)), staging, state).awaitTermination()
        return sorted(r.transaction_id for r in spark.read.parquet(staging).collect())

    with monkeypatch.context() as patched:
        patched.setattr(stream, "STATE_SETTINGS", {})
        assert load("a", "b") == ["a", "b"]
    assert load("b", "c") == ["a", "b", "c"]


def test_the_origin_of_streamed_sales_is_not_shuffled(spark, feed, tmp_path):
    feed("sales_transactions", {"transaction_id": "1"}).write.json(f"{tmp_path}/in")
    sales = stream.first_deliveries(stream.read_stream(spark, f"{tmp_path}/in"))
    below = sales._jdf.queryExecution().analyzed().toString().split("DeduplicateWithinWatermark")[1]
    assert "source_collection" in sales.columns and "source_collection" not in below
