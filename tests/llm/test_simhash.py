from __future__ import annotations

import random
import re

import pytest
import xxhash

from basketwork.llm import simhash
from llm_fixtures import docs, odd  # noqa: F401


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: dict) -> dict:
    """id -> least id reachable over links of at most 3 bits."""
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if label[b] < label[a] and (prints[a] ^ prints[b]).bit_count() <= 3:
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("text", [None, "", "ÄB Äb", "one", "One two", "a b c", "a\x0bb\x0cc\rd e", "x " * 500 + "ÉÉ Z"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode() if text is not None else None) == slow_fingerprint(text)


def near_values(seed=3):
    """Fingerprints in chains and clusters of few differing bits, and far ones."""
    rng = random.Random(seed)
    values = []
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(12):
            values.append(at)
            for bit in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4, 5])):
                at ^= 1 << bit
    return values


@pytest.mark.parametrize("plain_pairs, block", [(256, 1024), (0, 4), (2, 8)])
def test_links_join_what_brute_force_joins(spark, plain_pairs, block):
    values = sorted(set(near_values()))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {(r.node % (1 << 64), r.other % (1 << 64)) for r in simhash.links(fps, 3, plain_pairs, block).collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    want = brute_components({v: v for v in values})
    linked = {v: v for v in values}
    for r in simhash.components(simhash.links(fps, 3, plain_pairs, block)).collect():
        linked[r.node % (1 << 64)] = r.component
    groups = lambda d: {frozenset(k for k in d if d[k] == v) for v in d.values()}
    assert groups({v: linked[v] % (1 << 64) for v in values}) == groups(want)


def test_near_duplicates_against_brute_force(docs):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 6) for _ in range(400)) for _ in range(6)]
    texts = []
    for t in base:
        texts += [t, t.upper()] + [t + " " + " ".join(rng.choices("xyz", k=n)) for n in (1, 2, 3)]
    frame = docs(*texts, "", None, " ")
    rows = {r.doc_id: r for r in simhash.near_duplicates(frame).collect()}
    prints = {i: slow_fingerprint(t) for i, t in enumerate([*texts, "", None, " "])}
    assert {i: r.fingerprint for i, r in rows.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in rows.items()} == brute_components(prints)
    kept = simhash.without_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_components(prints).values()))


def test_odd_rows(odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 8 and {r.component_id for r in rows if r.fingerprint == "0" * 16} == {0}
    assert {r.component_id for r in rows if r.doc_id == 4} == {4}
    kept = simhash.without_near_duplicates(odd)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4] and kept.columns == odd.columns


def test_empty(docs):
    assert simhash.near_duplicates(docs()).count() == 0
    assert simhash.without_near_duplicates(docs()).count() == 0


def broadcast_parts(df) -> list[str]:
    """The parts of a plan below its broadcasts."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    out = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            out.append("\n".join(lines[i:end]))
    return out


@pytest.mark.parametrize("most", [0, 100_000])
def test_exploded_rows_are_not_broadcast(spark, monkeypatch, most):
    """Spark takes them for as few as the fingerprints, which fit a broadcast while the exploded rows do not."""
    monkeypatch.setattr(simhash, "BROADCAST_KEYS", most)
    fps = simhash.stored(spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in set(near_values())], "fp long"), "fps")
    found = simhash.links(fps, 3, 2, 8)
    parts = broadcast_parts(found)
    assert bool(parts) == bool(most) and not any("Generate" in part for part in parts)
    groups = lambda rows: {(r.node, r.component) for r in rows}
    assert groups(simhash.components(found).collect()) == groups(simhash.components(simhash.links(fps)).collect())
