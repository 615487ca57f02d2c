from __future__ import annotations

import re
from collections import Counter

from basketwork.llm import quality_rules as q
from llm_fixtures import docs, odd  # noqa: F401


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 5))
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


TEXTS = [
    "plain words make a quiet line here. " + " ".join(f"w{i}" for i in range(30)),
    "a b c d e f a b c d e g " + " ".join(f"w{i}" for i in range(60)),
    " ".join(["x"] * 40), "a b c d e " * 90 + "z", "same line of words\n" * 5,
    " ".join(f"u{i % 150} v{i % 150}" for i in range(900)),  # more repeated windows than FEW
    "one | two | three | four | five\n" + "home | about | help | faq | menu " * 6,
    "w%%% x*** y&&& z### " * 20, "a\x0bb\x0cc\rd\te f g h i j k l", "x" * 50_000, None, "", "\n \n",
    "clean opening words of a page that goes on\nAll rights reserved.\n" + " ".join(f"t{i}" for i in range(40)),
]


def test_figures(docs):
    rows = {r.doc_id: r for r in q.quality_report(docs(*TEXTS)).collect()}
    for i, t in enumerate(TEXTS):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == slow(t), i


def test_verdicts(docs):
    kept = {r.doc_id: r.kept for r in q.quality_report(docs(*TEXTS)).collect()}
    assert kept[0] and kept[13] and kept[8]
    assert not any(kept[i] for i in (2, 6, 7, 10, 11, 12))


def test_failing_lines_go(docs):
    frame = docs(TEXTS[13], TEXTS[7])
    rows = q.cleaned(frame).collect()
    assert [r.doc_id for r in rows] == [0] and "rights reserved" not in rows[0].text and rows[0].n_chars == len(rows[0].text)
    assert rows[0].text.startswith("clean opening")


def test_odd_and_empty(odd, docs):
    assert q.quality_report(odd).count() == 8 and q.quality_report(docs()).count() == 0
    assert q.cleaned(odd).columns == odd.columns and q.cleaned(docs()).count() == 0
