from __future__ import annotations

import random
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketwork.llm import simhash, similar
from llm_fixtures import docs, odd  # noqa: F401


def slow_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_components(texts):
    sets, label, changed = [slow_set(t) for t in texts], list(range(len(texts))), True
    near = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in near:
            low = min(label[a], label[b])
            changed |= label[a] != label[b]
            label[a] = label[b] = low
    return label


def edited(rng, n_texts=12):
    """Texts of 40 to 400 words and copies with a few words replaced, many of them near similarity 0.8."""
    texts = []
    for _ in range(n_texts):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(40, 400))]
        texts.append(" ".join(words))
        for share in (0.005, 0.01, 0.02, 0.03):
            copy = list(words)
            for at in rng.sample(range(len(copy)), max(1, int(share * len(copy)))):
                copy[at] = f"new{rng.randrange(5000)}"
            texts.append(" ".join(copy))
    return [*texts, texts[0].upper(), "", None, " ", "one two", "One  two"]


@pytest.mark.parametrize("block", [1024, 3])
def test_components_against_brute_force(docs, block, monkeypatch):
    monkeypatch.setattr(similar.links, "__defaults__", (similar.SIMILARITY, block, similar.BLOCK_BYTES))
    texts = edited(random.Random(5))
    found = {r.doc_id: r.component for r in similar.near_copies(docs(*texts)).collect()}
    want = slow_components(texts)
    groups = lambda label: {frozenset(k for k in label if label[k] == v) for v in label.values()}
    assert groups(found) == groups(dict(enumerate(want))) and len(set(want)) < len(texts) - 20


def test_stage_drops_copies_with_an_edited_word(spark, docs):
    rng = random.Random(8)
    texts = []
    for _ in range(20):
        words = [f"w{rng.randrange(5000)}" for _ in range(80)]
        texts += [" ".join(words), " ".join([*words[:40], "edited", *words[41:]])]
    kept = corpus_pipeline.near_duplicates(spark, docs(*texts), "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 40, 2))


def test_odd_and_empty(odd, docs):
    kept = similar.without_near_copies(odd)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4] and kept.columns == odd.columns
    assert similar.without_near_copies(docs()).count() == 0


def test_forests_join_what_links_join():
    """Components of the forest are those of all near pairs, within one block and across two."""
    rng = np.random.default_rng(3)
    for n, across in ((1, False), (2, True), (60, False), (60, True)):
        base = rng.integers(0, 9, (6, similar.BANDS * similar.ROWS), dtype=np.uint32)
        signatures = base[rng.integers(0, 6, n)].copy()
        for row in signatures:  # chains: neighbours agree, ends may not
            row[rng.integers(0, 64, rng.integers(0, 40))] = rng.integers(10, 99)
        nodes, shares = np.arange(100, 100 + n), np.arange(n) % 2 if across else np.zeros(n, int)
        near = {(i, j) for i in range(n) for j in range(n) if i != j and (signatures[i] == signatures[j]).mean() >= similar.LEAST_ESTIMATE and (not across or shares[i] != shares[j])}

        def label(links):
            least = list(range(n))
            for _ in range(n):
                for a, b in links:
                    least[a] = least[b] = min(least[a], least[b])
            return least

        edges = [(a - 100, b - 100) for a, b in similar.estimated(nodes, shares, signatures)]
        assert set(edges) <= near and len(edges) < n and label(edges) == label(near)


def test_chance_bands_do_not_join_groups(docs):
    """Texts that share long passages, and so bands by chance, but few of their shingles, are no candidates of each other."""
    rng = random.Random(6)
    common = " ".join(f"c{i}" for i in range(60))
    texts = [f"{common} " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(140)) for _ in range(120)]
    sketches = similar._named(docs(*texts)).mapInArrow(similar._sketches, "doc_id long, digest long, node long, bands array<long>, minima binary")
    keys = [k for r in sketches.collect() for k in r.bands]
    assert len(set(keys)) < len(keys)  # some bands do meet
    assert similar._candidate_groups(sketches).count() < 10


def test_fingerprints_bring_candidates_together(docs):
    """Texts that SimHash links are candidates of each other without any common band; their prints are those of `simhash`."""
    rng = random.Random(4)
    texts = []
    for _ in range(5):
        words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
        texts += [" ".join(words), " ".join([*words, "more"])]
    frame = similar._named(docs(*texts, "", "One two"))
    sketches = frame.mapInArrow(partial(similar._sketches, prints=True), f"{similar.SKETCH}, fp long")
    rows = sorted(sketches.collect(), key=lambda r: r.doc_id)
    prints = [simhash.fingerprint(t.encode(), similar.SHINGLE) for t in [*texts, "", "One two"]]
    assert [r.fp % (1 << 64) for r in rows] == prints
    close = [i for i in range(0, 10, 2) if (prints[i] ^ prints[i + 1]).bit_count() <= 3]
    assert len(close) >= 3
    apart = sketches.withColumn("bands", F.array(F.col("doc_id")))
    group = {r.node: r.component for r in similar._candidate_groups(apart, similar._print_links(apart)).collect()}
    assert all(group[rows[i].node] == group[rows[i + 1].node] for i in close) and len(set(group.values())) == len(close)


def test_texts_are_not_broadcast(docs, monkeypatch):
    """The file of many copies of one text is small, its rows are not."""
    plans, real = {}, similar.stored
    monkeypatch.setattr(similar, "stored", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()) and real(df, name))
    frame = real(docs(*["one text of six words here"] * 50, "another text of six words there"), "docs")
    assert len({r.component for r in similar.near_copies(frame).collect()}) == 2
    assert "SortMergeJoin [coalesce(doc_id" in plans["candidate-sets"]
