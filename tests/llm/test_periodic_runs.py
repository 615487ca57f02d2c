from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from basketwork.llm import periodic_runs as p
from basketwork.llm import queries
from llm_fixtures import docs, odd  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words: list) -> list[tuple[int, int, int]]:
    """start, length, smallest period of every run, by walking along every distance."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def sequences(seed: int) -> list[list[int]]:
    """Random, repeated, Fibonacci and Thue-Morse sequences, and periodic regions that meet out of phase."""
    rng = random.Random(seed)
    fibonacci, other, morse = [0, 1], [0], [0]
    while len(fibonacci) < 500:
        other, fibonacci = fibonacci, fibonacci + other
    for _ in range(9):
        morse = morse + [1 - x for x in morse]
    out = []
    for _ in range(40):
        base = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(120))]
        block, root = base[: rng.randrange(1, 60)] or [0], list(range(rng.randrange(1, 4)))
        turns = (root * rng.randrange(5, 40))[rng.randrange(3) :]
        tower = ([0, 1] * rng.randrange(3, 20) + [0]) * rng.randrange(1, 5)
        at = rng.randrange(100)
        out += [
            base, base[:10] + block * rng.randrange(1, 9) + base, turns + turns[1:] + turns, fibonacci[at : at + 300], morse[at : at + 400],
            (tower + [rng.randrange(2)]) * rng.randrange(1, 6) + tower,
        ]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_runs_equal_brute_force(seed):
    texts = sequences(seed)
    got = p._of_each([np.array(t, np.int32) for t in texts])
    for words, runs in zip(texts, got):
        assert [(s, e - s, q) for s, e, q in runs.tolist()] == brute(words)


def test_periods_of_meeting_regions_come_from_the_regions():
    """(ab)^k a (ab)^k has runs of many odd periods without any selected position at their scale."""
    words = np.array([0, 1] * 100 + [0] + [0, 1] * 100 + [-1], np.int32)
    want = brute(words.tolist())
    assert len(want) > 50
    assert [(s, e - s, q) for s, e, q in p.runs_of(words, 401).tolist()] == want


def test_a_collision_is_noticed_and_mended(monkeypatch):
    words = np.array(([0, 1, 2] + list(range(10, 60))) * 3, np.int32)
    want = brute(words.tolist())
    monkeypatch.setattr(p.Windows, "at", lambda self, start, size: np.zeros(len(start), np.uint64))
    with pytest.raises(ValueError):
        p.runs_of(words, len(words))
    assert [(s, e - s, q) for s, e, q in p._of_each([words])[0].tolist()] == want


def test_words_and_collapsed_text(docs):
    row = p.periodic_runs(docs("x  a b\ta b\na b a b a b a b y", "a b " * 12)).orderBy("doc_id").collect()
    assert [tuple(r) for r in row[0].runs] == [(1, 12, 2)] and row[0].collapsed == "x a b y"
    assert [tuple(r) for r in row[1].runs] == [(0, 12, 1)] and row[1].collapsed == "a b"


def planted(doc_id: int, text: str | None) -> list[str]:
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    q = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % q] for i in range(n)]


def test_query_equals_brute_force(spark, docs, tmp_path):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["a", "b", "cc", "dé"]) for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += [None, "", " \n ", "w " * 300, ("one two three four\n" * 30) + "end", " ".join(f"w{i}" for i in range(900))]
    docs(*texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for i, text in enumerate(texts):
        words = planted(i, text)
        runs = brute(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        r = rows[i]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *want)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == sha(" ".join(w for k, w in enumerate(words) if k not in dropped))


def test_odd_and_empty(odd, docs):
    rows = p.periodic_runs(odd).collect()
    assert len(rows) == 8 and [r.n_words for r in rows if r.doc_id in (0, 1, 2)] == [0, 0, 0]
    assert [[tuple(x) for x in r.runs] for r in rows if r.doc_id == 3] == [[(0, 12000, 3)]]
    assert p.periodic_runs(docs()).count() == 0
