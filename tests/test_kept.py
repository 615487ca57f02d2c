"""Kept daily aggregates, lineage reach, catalogue tables and views, deliveries."""

from __future__ import annotations

import datetime as dt
import random
import uuid

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from basketwork.operators import kept, lineage, lineage_views, validation
from basketwork.sources import deliveries, registry, sample_feeds

NOW = dt.datetime(2024, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def database(spark):
    name = f"test_{uuid.uuid4().hex}"
    registry.use_database(spark, name)
    return name


def sales(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, customer_id string, transaction_date date, amount decimal(18,2), quantity long")


def random_sales(seed: int, n: int = 400):
    rng = random.Random(seed)
    from decimal import Decimal

    return [(str(i), f"c{rng.randrange(40)}", dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(120)), Decimal(rng.randrange(1, 999)) / 100, rng.randrange(1, 5)) for i in range(n)]


def want_months(rows) -> dict:
    out = {}
    for _, c, d, a, q in rows:
        m = out.setdefault(f"{d:%Y-%m}", [0, 0, 0, set()])
        m[0], m[1], m[2] = m[0] + 1, m[1] + a, m[2] + q
        m[3].add(c)
    return {m: (n, float(a), q, len(s)) for m, (n, a, q, s) in out.items()}


def months(spark, store) -> dict:
    return {r.month: (r.transactions, r.revenue, r.units, r.buyers) for r in kept.monthly(spark, store).collect()}


def test_kept_months_equal_a_full_recompute(spark, tmp_path):
    store, rows = kept.Kept(str(tmp_path / "kept")), random_sales(1)
    assert len(kept.refresh(sales(spark, rows), store)) == len({r[2] for r in rows})
    assert months(spark, store) == want_months(rows)
    numbers = {r.customer_id: r.number for r in store.read(spark, "numbers").collect()}
    # one day changes in part, one goes, one comes with a new customer; a month loses its last day's neighbours
    day, gone, new = rows[0][2], rows[1][2], dt.date(2024, 8, 1)
    changed = [(i, "c1" if d == day else c, d, a, q) for i, c, d, a, q in rows if d != gone] + [("n", "brand new", new, rows[0][3], 1)]
    days = kept.refresh(sales(spark, changed), store)
    assert set(days) <= {day, gone, new} and {gone, new} <= set(days)
    assert months(spark, store) == want_months(changed)
    after = {r.customer_id: r.number for r in store.read(spark, "numbers").collect()}
    assert {c: after[c] for c in numbers} == numbers and len(set(after.values())) == len(after)
    assert kept.refresh(sales(spark, changed), store) == []


def test_named_days_alone_are_read(spark, tmp_path):
    store, rows = kept.Kept(str(tmp_path / "kept")), random_sales(5, 100)
    kept.refresh(sales(spark, rows), store)
    day, other = rows[0][2], next(r[2] for r in rows if r[2] != rows[0][2])
    more = rows + [("new", "x", day, rows[0][3], 1), ("late", "y", other, rows[0][3], 1)]
    assert kept.refresh(sales(spark, more), store, [day]) == [day]
    assert months(spark, store) == want_months(more[:-1])
    assert kept.refresh(sales(spark, more), store, []) == []
    assert kept.refresh(sales(spark, more), store) == [other] and months(spark, store) == want_months(more)


def test_a_month_without_sales_goes(spark, tmp_path):
    store, rows = kept.Kept(str(tmp_path / "kept")), random_sales(2, 60)
    kept.refresh(sales(spark, rows), store)
    fewer = [r for r in rows if r[2].month != 2]
    kept.refresh(sales(spark, fewer), store)
    assert months(spark, store) == want_months(fewer) and "2024-02" not in months(spark, store)


def test_months_do_not_read_sales(spark, tmp_path):
    store = kept.Kept(str(tmp_path / "kept"))
    kept.refresh(sales(spark, random_sales(3, 50)), store)
    text = plan(kept.monthly(spark, store))
    assert "transaction_id" not in text and "bitmap_or_agg" in text


def brute_reach(edges) -> dict:
    out = {}
    for start in {a for a, _ in edges}:
        frontier, depth, seen = {start}, 0, {start}
        while frontier:
            depth += 1
            frontier = {b for a, b in edges if a in frontier} - seen
            seen |= frontier
            out |= {(start, b): depth for b in frontier}
    return out


@pytest.mark.parametrize("edges", [
    [("a", "b"), ("b", "c"), ("c", "d"), ("a", "c")], [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "d")], [("a", "b")] * 3,
    [(str(i), str(i + 1)) for i in range(12)], [],
], ids=["paths", "cycle", "repeated", "chain", "none"])
def test_reach_equals_brute_force(spark, edges):
    got = lineage.reach(spark.createDataFrame(edges, "source_id string, target_id string")).collect()
    assert {(r.source_id, r.target_id): r.depth for r in got} == brute_reach([e for e in edges if e[0] != e[1]])


def test_depth_is_limited(spark):
    edges = spark.createDataFrame([(str(i), str(i + 1)) for i in range(9)], "source_id string, target_id string")
    assert lineage.reach(edges, max_depth=3).agg(F.max("depth")).first()[0] == 3


def test_views_last_and_show_what_tables_hold(spark, database):
    registry_tables = lineage.seed(spark, NOW)
    lineage_views.publish(spark, registry_tables, database)
    other = spark.newSession()  # another session of the same catalogue; temporary views would not be seen
    assert other.table(f"{database}.v_complete_lineage").count() == lineage.complete_lineage(registry_tables).count() > 0
    for name, build in lineage.VIEWS.items():
        want, got = build(registry_tables), other.table(f"{database}.{name}")
        assert sorted(want.columns) == sorted(got.columns)
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    more = registry_tables.relationships.limit(1).withColumn("relationship_id", F.lit("again"))
    registry.save_table(more, f"{database}.lineage_relationships", "append")
    spark.catalog.refreshTable(f"{database}.lineage_relationships")
    assert spark.table(f"{database}.v_complete_lineage").filter("relationship_id = 'again'").count() == 1


def test_existence_gates(spark, database):
    registry.save_table(spark.range(3), f"{database}.there")
    names = [f"{database}.there", f"{database}.gone"]
    got = {r.table_name: (r.table_exists, r.record_count) for r in validation.existence(spark, names).collect()}
    assert got == {"there": (True, 3), "gone": (False, None)}
    validation.require_tables(spark, names[:1])
    with pytest.raises(validation.GateError, match="gone"):
        validation.require_tables(spark, names)


def test_bucketed_tables_join_without_exchange(spark, database):
    left = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("a"))
    right = spark.range(500).select(F.col("id").cast("string").alias("k"), (F.col("id") * 3).alias("b"))
    registry.save_bucketed(left, f"{database}.l", "k", 8)
    registry.save_bucketed(right, f"{database}.r", "k", 8)
    joined = spark.table(f"{database}.l").hint("merge").join(spark.table(f"{database}.r"), "k")
    summed = joined.groupBy("k").agg(F.sum("a").alias("a"))
    assert "Exchange" not in plan(summed) and "SortMergeJoin" in plan(summed)
    assert joined.count() == 500
    apart = left.hint("merge").join(right, "k")
    assert "Exchange" in plan(apart)


def people(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, age int")


def report_of(df) -> dict:
    return {r.status: r.records for r in df.collect()}


def test_deliveries_tell_new_changed_and_repeated_apart(spark, database):
    index = f"{database}.people"
    take = lambda n, rows: deliveries.take_delivery(people(spark, rows), "id", index, n, buckets=4)
    first, report = take(1, [("1", "a", 1), ("2", "b", 2), ("2", "b", 2), ("3", None, 3), (None, "x", 1), (None, "x", 1)])
    assert report_of(report) == {"new": 3, "repeated": 1, "no_key": 2}
    assert sorted(r.id for r in first.collect()) == ["1", "2", "3"]
    second = [("1", "a", 1), ("2", "bb", 2), ("3", "", 3), ("4", "d", 4), ("4", "d", 5)]
    brought, report = take(2, second)
    assert report_of(report) == {"new": 1, "changed": 3, "repeated": 1}  # null and empty text differ
    assert sorted((r.id, r.age) for r in brought.collect()) == [("2", 2), ("3", 3), ("4", 4), ("4", 5)]
    # taken again after a failure: the same answer, and the index is as it was
    size = spark.table(index).count()
    assert report_of(take(2, second)[1]) == {"new": 1, "changed": 3, "repeated": 1} and spark.table(index).count() == size
    # back to an earlier version is a change against the latest
    assert report_of(take(3, [("2", "b", 2), ("2", "bb", 2)])[1]) == {"changed": 1, "repeated": 1}
    assert report_of(take(4, [])[1]) == {}


def test_the_index_is_not_shuffled(spark, database):
    index = f"{database}.people"
    deliveries.take_delivery(people(spark, [("1", "a", 1)]), "id", index, 1, buckets=4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(deliveries._latest(spark, index, 2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Exchange" not in text


@pytest.mark.skipif(not DATA.exists(), reason="sample tables not present")
def test_digests_of_real_rows_are_equal_only_for_equal_rows(spark):
    feed = sample_feeds.customers(spark, str(DATA))
    digests = feed.select(deliveries.content_digest(feed).alias("d")).distinct().count()
    assert digests == feed.distinct().count()
