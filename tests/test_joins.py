from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketwork.operators.joins import attach, broadcast_limit, column_bytes, first_per_key, hot_keys, matched_counts


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one known key, a third on an unknown one, some without key."""
    n = F.col("id")
    key = (
        F.when(n % 3 == 0, F.lit("hot")).when(n % 3 == 1, F.lit("")).when(n % 11 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (n % 50).cast("string")))
    )
    return spark.range(3000).select(n, key.alias("key"))


@pytest.fixture(scope="module")
def dim(spark):
    rows = [("hot", 1)] + [(f"k{i}", i) for i in range(0, 50, 2)]
    return spark.createDataFrame(rows, "key string, size int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_both_plans_give_the_plain_join(skewed, dim, how):
    expected = sorted(map(str, skewed.join(dim, "key", how).collect()))
    small = sorted(map(str, attach(skewed, dim, "key", how, dim_bytes=1, salt_on="id").collect()))
    salted = attach(skewed, dim, "key", how, dim_bytes=2**40, salt_on="id", share=0.02, min_rows=1)
    unsalted = attach(skewed, dim, "key", how, dim_bytes=2**40, salt_on="id")
    assert small == expected
    assert sorted(map(str, salted.collect())) == expected
    assert sorted(map(str, unsalted.collect())) == expected


def test_hot_keys_get_a_salt_per_share(skewed):
    out = {r["key"]: r["__salts"] for r in hot_keys(skewed, "key", 0.1, min_rows=1).collect()}
    # nulls are not counted: a third of 3000 rows are 1000 of about 2900
    assert set(out) == {"hot", ""} and set(out.values()) == {4}
    assert hot_keys(skewed, "key").count() == 0  # no key has a million rows
    many = hot_keys(skewed, "key", 0.001, min_rows=1).agg(F.count("key"), F.sum("__salts")).first()
    assert many[0] < 1000 and many[1] < 2000


def test_large_dimensions_are_not_broadcast(spark, skewed, dim):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert broadcast_limit(spark) == -1
        joined = attach(skewed, dim, "key", "left", dim_bytes=1, salt_on="id", share=0.02, min_rows=1)
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("strategy=broadcast") + plan.count("rightHint=(strategy=broadcast)") >= 2
        physical = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in physical and "CartesianProduct" not in physical
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sizes = joined.filter("key = 'hot'").select("key").rdd.glom().map(len).collect()
        assert sum(sizes) == 1000 and max(sizes) < 1000  # the hot key is spread over tasks
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_column_bytes_measures_text(spark):
    df = spark.createDataFrame([("ab", 1), ("abcd", 2)], "text string, n int")
    assert column_bytes(df) == {"text": 6 + 32, "n": 32}
    assert column_bytes(df.limit(0)) == {"text": 0, "n": 0}


def test_matched_counts(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "key string")
    keys = spark.createDataFrame([("a",), ("c",)], "key string")
    out = {(r["key"], r["n_rows"], r["n_dim"]) for r in matched_counts(rows, keys, "key").collect()}
    assert out == {("a", 2, 1), ("b", 1, None), (None, 1, None), ("c", None, 1)}


def test_unknown_join_types_are_refused(skewed, dim):
    with pytest.raises(ValueError):
        attach(skewed, dim, "key", "full_outer", 1, salt_on="id")


def test_first_per_key_limits_before_the_shuffle(skewed):
    out = first_per_key(skewed, "key", [F.desc("id")])
    plan = out._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    best = {r["key"]: r["id"] for r in out.collect()}
    assert best["hot"] == 2997 and best[""] == 2998
