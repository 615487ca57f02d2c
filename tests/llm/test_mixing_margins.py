from __future__ import annotations

import random
from collections import defaultdict

import numpy as np

from basketwork.llm import mixing
from llm_fixtures import DOCS, docs  # noqa: F401


def test_selected_documents_meet_the_targets(spark):
    rng, rows = random.Random(2), []
    for i in range(20000):
        word = rng.choices(("w", "License", "2024", "a@b.io"), (0.9, 0.05, 0.04, 0.01))[0]
        text = " ".join([word] + ["w"] * rng.randint(4, 30))
        rows.append((i, text, rng.choices(("en", "de", "fr"), (0.8, 0.15, 0.05))[0], rng.choices(("a", "b", "c"), (0.9, 0.09, 0.01))[0], len(text)))
    frame = spark.createDataFrame(rows, DOCS)
    chosen, tokens = mixing.mixture(frame).filter("selected").collect(), sum(len(r[1].split()) for r in rows)
    total = sum(r.n_tokens for r in chosen)
    assert abs(total / tokens - 0.5) < 0.01
    report = mixing.margins(frame).collect()
    for dimension in mixing.DIMENSIONS:
        got = defaultdict(int)
        for r in chosen:
            got[r[dimension]] += r.n_tokens
        for r in (r for r in report if r.dimension == dimension):
            assert abs(r.expected - r.reachable) < 0.001 * tokens and abs(got[r.value] - r.reachable) < 0.01 * tokens
    short = [r for r in report if r.target * tokens * 0.5 > r.reachable * 1.001]
    assert {(r.dimension, r.value) for r in short} >= {("source", "c"), ("topic", "contacts")}


def test_cells_keep_within_their_tokens():
    codes = [np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])]
    tokens = np.array([100.0, 10.0, 40.0, 50.0])
    weight, goals = mixing.bounded(codes, tokens, [np.array([0.4, 0.6])] * 2, 100.0)
    assert np.all(weight <= tokens) and np.allclose([np.bincount(c, weight) for c in codes], goals, atol=1e-3) and np.allclose(goals, [[40, 60]] * 2)
    assert np.allclose(mixing.reachable(np.array([0.5, 0.3, 0.2]), np.array([20.0, 100.0, 100.0]), 100.0), [20, 48, 32])
    assert mixing.reachable(np.array([1.0, 0.0]), np.array([5.0, 9.0]), 7.0).tolist() == [5, 0]
