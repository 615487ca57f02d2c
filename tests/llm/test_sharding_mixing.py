from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from basketwork.llm import mixing, sharding
from llm_fixtures import docs, odd  # noqa: F401


def bits_of(key):
    return f"{int(hashlib.md5(key.encode()).hexdigest()[:15], 16):060b}"


def slow_shards(rows, limit):
    """Extendible hashing one bucket at a time."""
    done, work = {}, [("", list(rows))]
    while work:
        prefix, bucket = work.pop()
        if sum(n for _, n in bucket) <= limit or len(bucket) == 1:
            done |= {i: "s" + prefix for i, _ in bucket}
            continue
        for bit in "01":
            part = [(i, n) for i, n in bucket if bits_of(str(i))[len(prefix)] == bit]
            if part:
                work.append((prefix + bit, part))
    return done


def test_shards_against_splitting_one_by_one(docs):
    texts = ["y" * (37 * i % 900) for i in range(400)]
    found = {r.doc_id: r.shard_id for r in sharding.sharded(docs(*texts), 5000).collect()}
    assert found == slow_shards(list(enumerate(map(len, texts))), 5000)


def test_repeated_ids_and_large_rows(docs):
    frame = docs(*[(7, "z" * 100)] * 300, (8, "w" * 5000), *[(i, "v" * 50) for i in range(100, 160)])
    out = sharding.sharded(frame, 2000)
    sizes, rows = Counter(), Counter()
    for r in out.collect():
        sizes[r.shard_id] += r.n_bytes
        rows[r.shard_id] += 1
    assert sum(rows.values()) == 361 and all(n <= 2000 or rows[s] == 1 for s, n in sizes.items())


def test_odd_and_empty_shards(odd, docs):
    out = sharding.sharded(odd, 1000)
    assert out.count() == 8 and set(out.columns) == {*odd.columns, "n_bytes", "shard_depth"}
    assert sharding.sharded(docs()).count() == 0


def test_raking_meets_the_targets(spark):
    cells = spark.createDataFrame([("a", "x", "p", 900), ("a", "y", "q", 50), ("b", "x", "q", 30), ("b", "y", "p", 20), ("a", "x", "q", 10)], "_source string, _lang string, _topic string, _tokens long")
    shares = {"_source": {"a": 0.5, "b": 0.5}, "_lang": {"x": 0.6, "y": 0.4}, "_topic": {"p": 0.5, "q": 0.5}}
    targets = {d: spark.createDataFrame(list(v.items()), f"{d} string, share double") for d, v in shares.items()}
    rows = mixing.raked(cells, targets, rounds=12).collect()
    for d, want in shares.items():
        got = defaultdict(float)
        for r in rows:
            got[r[d]] += r._weight
        assert all(abs(got[v] / sum(got.values()) - share) < 1e-3 for v, share in want.items())


def test_mixture_draws_by_probability(spark, docs):
    frame = docs(*[" ".join(["w"] * (5 + i % 7)) for i in range(3000)])
    rows = mixing.mixture(frame).collect()
    assert abs(sum(r.selected for r in rows) - sum(r.probability for r in rows)) < 100
    again = {r.doc_id for r in mixing.sampled(frame).collect()}
    assert again == {r.doc_id for r in rows if r.selected}
    given = mixing.calibrated(frame, weights={"source": {"s0": 1.0, "s1": 1.0}}).collect()
    assert abs(sum(r._share for r in given if r._source == "=s0") - 0.5) < 1e-6
    assert all(r._share == 0 for r in given if r._source == "=s2")


def test_odd_and_empty_mixtures(odd, docs):
    null_source = odd.withColumns({"source": F.lit(None).cast("string"), "topic": F.lit("t")})
    rows = mixing.mixture(null_source).collect()
    assert len(rows) == 8 and all(r.probability == 0 for r in rows if not (r.text or "").split()) and {r.topic for r in rows} == {"t"}
    assert mixing.sampled(odd).columns == odd.columns and mixing.mixture(docs()).count() == 0
