from __future__ import annotations

import random

import pytest

from basketwork.llm import decontamination as d
from llm_fixtures import docs, odd  # noqa: F401


def slow_distance(pattern, region):
    """Least edit distance of the pattern to any part of the region."""
    row = [0] * (len(region) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, r in enumerate(region, 1):
            row.append(min(last[j - 1] + (p != r), last[j] + 1, row[j - 1] + 1))
    return min(row)


def edited(words, n, rng, other):
    words = list(words)
    for _ in range(n):
        kind, at = rng.randrange(3), rng.randrange(len(words))
        if kind == 0:
            words[at] = rng.choice(other)
        elif kind == 1:
            words.insert(at, rng.choice(other))
        else:
            words.pop(at)
    return words


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(5)
    return ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(400)]


def items_of(vocabulary, n=30, seed=2):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(vocabulary, k=rng.randint(8, 60)))) for i in range(n)]


def test_edit_distance(vocabulary):
    rng = random.Random(1)
    for _ in range(200):
        pattern, region = rng.choices(vocabulary[:8], k=rng.randint(1, 70)), rng.choices(vocabulary[:8], k=rng.randint(0, 90))
        item = d.Item(0, pattern)
        assert d.best_end(item.masks, len(pattern), region)[0] == slow_distance(pattern, region)


def test_matches_against_brute_force(vocabulary):
    """Every reported pair is right; of the true ones at most a few at the edge are missed."""
    rng, items = random.Random(3), items_of(vocabulary)
    matcher, texts = d.Matcher(items), []
    for _, text in items:
        for share in (0, 0.5, 1, 2):
            n = round(d.budget(len(text.split())) * share)
            middle = edited(text.split(), n, rng, vocabulary)
            texts.append(" ".join(rng.choices(vocabulary, k=50) + middle + rng.choices(vocabulary, k=50)))
    found = matcher.matches(texts)
    want = {(k, n) for k, t in enumerate(texts) for n, x in enumerate(matcher.items) if slow_distance(x.words, t.split()) <= d.budget(len(x.words))}
    got = {(k, n) for k, r in enumerate(found) for n in r}
    assert got <= want and len(got) >= 0.98 * len(want) and len(want) >= 3 * len(items)
    assert all(r[n][0] >= slow_distance(matcher.items[n].words, texts[k].split()) for k, r in enumerate(found) for n in r)


@pytest.mark.parametrize("n_words", [*range(1, 13), 14, 15, 17, 20, 24, 25, 30, 40, 60])
def test_recall_at_each_length(vocabulary, n_words):
    """Items with random edits at the limit; all found below SHORT_WORDS, 95 % and more from there."""
    rng, texts = random.Random(n_words), []
    items = [(i, " ".join(rng.choices(vocabulary, k=n_words))) for i in range(120)]
    matcher = d.Matcher(items)
    for _, text in items:
        middle = edited(text.split(), d.budget(n_words), rng, ["zz", "yy"])
        texts.append(" ".join(rng.choices(vocabulary, k=20) + middle + rng.choices(vocabulary, k=20)))
    found = matcher.matches(texts)
    want = [i for i, t in enumerate(texts) if slow_distance(matcher.items[i].words, t.split()) <= d.budget(n_words)]
    hits = sum(i in found[i] for i in want)
    assert len(want) >= 110 and hits >= (1 if n_words < d.SHORT_WORDS else 0.95) * len(want)


def test_short_items_equal_brute_force():
    rng = random.Random(4)
    items = [(i, " ".join(rng.choices("abcde", k=rng.randint(1, 11)))) for i in range(40)]
    texts = [" ".join(rng.choices("abcdefg", k=rng.randint(0, 60))) for _ in range(60)]
    matcher = d.Matcher(items)
    want = {(k, n) for k, t in enumerate(texts) for n, x in enumerate(matcher.items) if slow_distance(x.words, t.split()) <= d.budget(len(x.words))}
    assert {(k, n) for k, r in enumerate(matcher.matches(texts)) for n in r} == want and len(want) > 300


def test_spans_are_of_the_text_as_it_is():
    text = "İİ one Two İx"
    first = d.words_of(text).index("one")
    low, high = d._spans(text, first, first + 2)
    assert text[low:high] == "one Two"


def test_evenly_spread_edits(vocabulary):
    """The hardest case: as many substitutions as the budget allows, at even distances."""
    items, hits = items_of(vocabulary, 60, 9), 0
    matcher = d.Matcher(items)
    for i, (_, text) in enumerate(items):
        words = text.split()
        k = d.budget(len(words))
        for j in range(k):
            words[(2 * j + 1) * len(words) // (2 * k)] = "zzz"
        hits += i in matcher.matches([" ".join(words)])[0]
    assert hits >= 0.9 * len(items)


def test_frames(spark, docs, vocabulary):
    items = items_of(vocabulary)
    benchmark = spark.createDataFrame([*items, (98, "too short"), (99, None), (97, items[3][1])], "item_id long, text string")
    clean = " ".join(random.Random(8).choices(vocabulary, k=300))
    frame = docs(clean, f"{clean}\n{items[3][1].upper()}. {clean}", items[0][1], None, "")
    rows = d.contaminated(frame, benchmark).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in rows} == {(1, 3, 0), (1, 97, 0), (2, 0, 0)}
    whole = frame.collect()[1].text
    assert all(whole[r.start : r.end].lower() == items[3][1] for r in rows if r.doc_id == 1)
    assert sorted(r.doc_id for r in d.decontaminated(frame, benchmark).collect()) == [0, 3, 4]


def test_blocks_find_the_same(spark, docs, vocabulary, monkeypatch):
    items = items_of(vocabulary)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = docs(*[t for _, t in items])
    blocks = list(d.item_blocks(benchmark, 7))
    assert len(blocks) == 5 and sorted(i for b in blocks for i, _ in b) == list(range(30))
    monkeypatch.setattr(d.item_blocks, "__defaults__", (7,))
    assert sorted((r.doc_id, r.item_id) for r in d.contaminated(frame, benchmark).collect()) == [(i, i) for i in range(30)]


def test_odd_and_empty(spark, odd, docs):
    benchmark = spark.createDataFrame([(1, "one two three one two three")], "item_id long, text string")
    assert [r.doc_id for r in d.contaminated(odd, benchmark).collect()] == [3]
    kept = d.decontaminated(odd, benchmark)
    assert kept.count() == 7 and kept.columns == odd.columns
    assert d.contaminated(docs(), benchmark).count() == 0 and d.contaminated(odd, benchmark.limit(0)).count() == 0
    assert d.decontaminated(odd, benchmark.limit(0)).count() == 8
