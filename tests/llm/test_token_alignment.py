from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from basketwork.llm import queries
from basketwork.llm import token_alignment as ta
from basketwork.llm.token_counts import tokenizer_file
from llm_fixtures import docs, odd  # noqa: F401

ODD = [
    None, "", " a", "a ", "a  b", "  ", "\n", "a\n b", " \n", "x　y 　 z", "é “q” ”w é", "<|endoftext|> <s> </s> <unk> <0x41>", "▁a ▁", "▁", "á b́",
    "ﬁ ½", "a\tb  \t c", "İ Σ", "😀 😀😀", "ab" * 3000, " ".join(["na"] * 3000), "don't I'll  's", " a   b", "a\r\nb \r\n c", "The end.\nNext one",
]


@pytest.fixture(scope="module")
def texts() -> list[str | None]:
    rng = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "é", "　", "'s", "12", ".", " .", "▁", "😀", "Z", " the ", "tion", " in", "-", "_", "”"]
    return ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(300)]


def whole(text: str | None) -> dict:
    """Tokens of the whole text by the libraries, and their alignment by walking along both sides."""
    t = ta._tokenizers(tokenizer_file(ta.A_FILE), tokenizer_file(ta.B_FILE))
    text = text or ""
    a = t.a.encode(" " + text, add_special_tokens=False).ids
    b = t.b.encode(text)
    entry = [[x.as_py() for x in side] for side in t.bytes] if not hasattr(whole, "entry") else whole.entry
    whole.entry = entry
    wanted = b" " + text.encode()
    if not text or b"".join(entry[0][i] for i in a) != wanted or b"".join(entry[1][i] for i in b) != wanted:
        return {"a": [], "b": [], "groups": [], "overlaps": [], "links": []}
    groups, overlaps, links, i, j, end_a, end_b, first = [], [], [], 0, 0, len(entry[0][a[0]]), len(entry[1][b[0]]), (0, 0)
    while i < len(a) and j < len(b):
        overlaps.append((i, j))
        step_a, step_b = end_a <= end_b, end_b <= end_a
        if step_a and step_b:
            links.append((a[i], b[j]))
            groups.append((a[first[0] : i + 1], b[first[1] : j + 1]))
            first = (i + 1, j + 1)
        if step_a:
            i += 1
            end_a += len(entry[0][a[i]]) if i < len(a) else 0
        if step_b:
            j += 1
            end_b += len(entry[1][b[j]]) if j < len(b) else 0
    return {"a": a, "b": b, "groups": groups, "overlaps": overlaps, "links": links}


def written(groups) -> str:
    return ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)


def test_alignment_equals_a_walk_along_whole_texts(docs, texts):
    rows = {r.doc_id: r for r in ta.alignments(docs(*texts), with_overlaps=True).collect()}
    assert len(rows) == len(texts)
    some = 0
    for i, text in enumerate(texts):
        want, r = whole(text), rows[i]
        some += bool(want["a"])
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == tuple(len(want[k]) for k in ("a", "b", "groups", "links")), repr(text)
        assert r.groups == written(want["groups"])
        assert sorted((o.a, o.b) for o in r.overlaps) == want["overlaps"] and r.n_overlaps == len(want["overlaps"])
        size = 32_000
        assert dict(zip(r.pairs, r.pair_links)) == Counter(a * size + b for a, b in want["links"])
    assert some > 100


def test_query_equals_brute_force(spark, docs, texts, tmp_path):
    docs(*texts, *texts[20:60]).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.op13_token_alignment(spark, str(tmp_path)).collect()}
    want = {i: whole(t) for i, t in enumerate([*texts, *texts[20:60]])}
    counts = Counter(pair for w in want.values() for pair in w["links"])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    assert len(rows) == len(want)
    for i, w in want.items():
        r = rows[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == tuple(len(w[k]) for k in ("a", "b", "groups", "links"))
        assert r.count_sum == sum(counts[x] for x in w["links"])
        assert r.n_best == sum(counts[x] == most[x[1]] for x in w["links"])
        assert r.groups_sha256 == (hashlib.sha256(written(w["groups"]).encode()).hexdigest() if w["a"] else "")


def test_vocabularies_bound_the_pairs(spark, docs, texts):
    t = ta._tokenizers(tokenizer_file(ta.A_FILE), tokenizer_file(ta.B_FILE))
    assert ta.most_pairs(t) < 400_000
    a, b = (side.to_pylist() for side in t.bytes)
    for r in ta.pair_counts(ta.alignments(docs(*texts)), t.n_b).collect():
        x, y = a[r.pair // t.n_b], b[r.pair % t.n_b]
        assert x.endswith(y) or y.endswith(x)


def test_slices_and_memory_do_not_change_results(docs, texts, monkeypatch):
    t = ta._tokenizers(tokenizer_file(ta.A_FILE), tokenizer_file(ta.B_FILE))
    want = [(r["n_a"], r["groups"]) for r in ta._aligned(t, list(range(len(texts))), texts, False).to_pylist()]
    monkeypatch.setattr(ta, "MEMO_CHUNKS", 3)
    got = [(r["n_a"], r["groups"]) for i in range(0, len(texts), 7) for r in ta._aligned(t, list(range(len(texts)))[i : i + 7], texts[i : i + 7], True).to_pylist()]
    assert got == want


def test_odd_and_empty(odd, docs):
    rows = ta.link_report(odd).collect()
    assert len(rows) == 8
    assert all((r.n_a, r.n_links, r.count_sum, r.groups_sha256) == (0, 0, 0, "") for r in rows if r.doc_id in (0, 1))
    assert ta.link_report(docs()).count() == 0
