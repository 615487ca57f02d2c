from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from basketwork.llm import toxicity as t
from llm_fixtures import docs, odd  # noqa: F401

GOOD = [f"word{i}" for i in range(200)]


def corpus(n=600, seed=4):
    """Documents of neutral sentences; the toxic ones hold one sentence with a bad stem."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        sentences = [" ".join(rng.choices(GOOD, k=8)) for _ in range(6)]
        if bad := i % 4 == 0:
            sentences[rng.randrange(6)] += f" vequ{rng.choice('abcdefgh')}{rng.randrange(9)} idiot"[: rng.choice([7, 13])]
        rows.append((i, ". ".join(sentences) + ".", int(bad)))
    return rows


@pytest.fixture(scope="module")
def frames(spark, docs):
    rows = corpus()
    return docs(*[(i, x) for i, x, _ in rows]), spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_places(frames):
    docs, labels = frames
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = t.toxicity(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    found = [r for r in held if r.predicted and truth[r.doc_id]]
    assert found and all("vequ" in texts[r.doc_id][r.worst_start : r.worst_end] for r in found)


def test_noisy_or():
    assert t.noisy_or([]) == 0 and abs(t.noisy_or([0.5, 0.5]) - 0.75) < 1e-12 and 0.999 < t.noisy_or([1.0, 0.2]) <= 1


def test_held_out_labels_do_not_matter(spark, frames):
    docs, labels = frames
    flipped = labels.withColumn("toxic", t.F.when(t.held_out(t.F.col("doc_id")), 1 - t.F.col("toxic")).otherwise(t.F.col("toxic")))
    a, b = t.learnt(docs, labels), t.learnt(docs, flipped)
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_sample_is_bounded(frames):
    ids, weight = t.training_ids(frames[1], 20, 30)
    assert [r[1] for r in sorted(ids.groupBy("toxic").count().collect())] == [30, 20] and weight > 1


def test_odd_and_empty(spark, odd, docs, frames):
    rows = t.toxicity(odd, frames[1]).collect()
    assert len(rows) == 8 and all(r.score == 0 and r.worst_start is None for r in rows if r.doc_id in (0, 1, 2))
    assert t.toxicity(docs(), frames[1]).count() == 0
    none = spark.createDataFrame([(None, 1, 1), (3, 1, None)], frames[1].schema)
    assert {r.predicted for r in t.toxicity(odd, none).collect()} == {0}
