"""The streamed fact against the batch transform over the same deliveries."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from basketwork.operators import star
from basketwork.sources import tables
from basketwork.sources.layout import Layout
from basketwork.streaming import fact as stream

LOADED = dt.datetime(2024, 6, 30)
LAYOUTS = [Layout("month"), Layout("day")]


def deliveries(seed: int, drops: int = 4) -> list[list[dict]]:
    """Repeats, better and worse versions, versions on other days, sales that leave the fact, unknown keys, no id."""
    rng = random.Random(seed)
    out = []
    for _ in range(drops):
        rows = []
        for _ in range(rng.randrange(8, 20)):
            rows.append({
                "transaction_id": rng.choice([None, *map(str, range(12))]), "customer_id": rng.choice(["a", "b", "nobody"]),
                "product_id": rng.choice(["p", "p", "p", "nothing"]), "status": rng.choice(["COMPLETED", "pending", "cancelled", "completed"]),
                "transaction_date": rng.choice([None, *(dt.datetime(2024, m, d) for m in (4, 5, 6) for d in (1, 2, 30))]),
                "amount": rng.choice([0.0, 10.0, 12.5]),
            })
        out.append(rows + rng.sample(rows, 2))
    return out


@pytest.fixture
def shop(spark, feed, tmp_path):
    """`shop(layout)`: target and functions to deliver rows, to run the stream and to compare with the batch."""

    def make(layout):
        root = str(tmp_path / layout.folder)
        dims = star.dim_customers(feed("customers", {"customer_id": "a"}, {"customer_id": "b"})), star.dim_products(feed("products", {"product_id": "p"}))
        for df, name in zip(dims, ("dim_customers", "dim_products")):
            tables.write_dimension(df, name, f"{root}/{name}")
        target = stream.Target(root, f"{root}/state", layout, F.lit(LOADED))
        seen: list[dict] = []

        def deliver(rows):
            seen.extend(rows)
            feed("sales_transactions", *rows).coalesce(1).write.mode("append").json(f"{root}/in")

        def run():
            stream.stream_into_fact(stream.arrivals(spark, f"{root}/in", 1), target, f"{root}/progress").awaitTermination()

        def check():
            want = star.fact_sales(feed("sales_transactions", *seen), *dims, loaded_at=F.lit(LOADED))
            got = tables.stored_or_empty(spark, target.fact, layout.with_folder(want).schema).select(*want.columns)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
            return want.count()

        return target, deliver, run, check

    return make


@pytest.mark.parametrize(("layout", "seed"), [(LAYOUTS[0], 1), (LAYOUTS[1], 2)], ids=["month", "day"])
def test_equals_the_batch_after_every_delivery(shop, layout, seed):
    _, deliver, run, check = shop(layout)
    for rows in deliveries(seed, 3):
        deliver(rows)
        run()
        check()


def test_several_batches_in_one_run_and_none_in_the_next(shop):
    _, deliver, run, check = shop(LAYOUTS[0])
    for rows in deliveries(3, 2):
        deliver(rows)
    run()
    assert check() > 0
    run()
    check()


@pytest.mark.parametrize(("step", "after"), [("replace_days", False), ("replace_days", True), ("remove_folder", False)])
def test_a_batch_that_broke_off_is_done_again(shop, monkeypatch, step, after):
    """Broken before or after the step, once; the stream is started anew on its checkpoint."""
    target, deliver, run, check = shop(LAYOUTS[1])
    deliver([{"transaction_id": "1", "customer_id": "a", "product_id": "p"}, {"transaction_id": "2", "customer_id": "a", "product_id": "p"}])
    run()
    # sale 1 moves to another day, sale 2 leaves the fact
    moved = {"transaction_id": "1", "customer_id": "b", "product_id": "p", "status": "COMPLETED", "transaction_date": dt.datetime(2024, 5, 2)}
    deliver([moved, {"transaction_id": "2", "customer_id": "a", "product_id": "p", "status": "COMPLETED", "amount": 0.0}])
    real, calls = getattr(tables, step), []

    def breaks(*args, **kw):
        calls.append(1)
        if len(calls) == 1:
            if after:
                real(*args, **kw)
            raise RuntimeError("lost")
        return real(*args, **kw)

    monkeypatch.setattr(tables, step, breaks)
    with pytest.raises(StreamingQueryException):
        run()
    run()
    assert len(calls) >= 2 and check() == 1
    assert [d for d in os.listdir(target.fact) if "=" in d] == ["transaction_date=2024-05-02"]


def test_compacted_state_gives_the_same(spark, shop):
    target, deliver, run, check = shop(LAYOUTS[0])
    first, second, *rest = deliveries(4, 3)
    for rows in (first, second):
        deliver(rows)
        run()
    stream.compact_state(spark, target, 1)
    assert {d for d in os.listdir(target.state) if "=" in d} == {"batch_id=1"}
    for rows in rest:
        deliver(rows)
        run()
        check()


def test_a_batch_without_sales(spark, shop, feed):
    target, *_ = shop(LAYOUTS[0])
    stream.merge_batch(feed("sales_transactions").limit(0), 0, target)
    stream.merge_batch(feed("sales_transactions", {"transaction_id": None}), 1, target)
    assert not os.path.exists(target.fact)


def test_only_touched_folders_are_read_and_written(spark, shop):
    target, deliver, run, check = shop(LAYOUTS[1])
    deliver([{"transaction_id": str(d), "customer_id": "a", "product_id": "p", "transaction_date": dt.datetime(2024, 6, d)} for d in (1, 2, 3)])
    run()
    files = {d: os.listdir(f"{target.fact}/transaction_date=2024-06-0{d}") for d in (1, 2, 3)}
    deliver([{"transaction_id": "9", "customer_id": "a", "product_id": "p", "transaction_date": dt.datetime(2024, 6, 2)}])
    run()
    check()
    same = {d: os.listdir(f"{target.fact}/transaction_date=2024-06-0{d}") == files[d] for d in files}
    assert same == {1: True, 2: False, 3: True}


def test_versions_are_not_written_again(shop):
    """Beside the state only the rows of the batch that reach the fact are kept; earlier versions are read where they lie."""
    target, deliver, run, check = shop(LAYOUTS[0])
    for rows in deliveries(5, 2):
        deliver(rows)
        run()
    assert check() > 0 and os.listdir(f"{target.state}-scratch") == ["rows"]
