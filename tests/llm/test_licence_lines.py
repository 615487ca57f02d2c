from __future__ import annotations

import random
import re

import pytest

from basketwork.llm import licences
from llm_fixtures import docs  # noqa: F401


def slow_known(text):
    """Identifiers of known sentences: from each line or sentence start, the longest run of lines that is known."""
    table = {re.sub(r"(?<=v)\. ", " ", s): i for s, i in licences.sentence_ids().items()}
    plain = lambda s: re.sub(r"(?<=\bv)\. ", " ", re.sub(r"[^a-z0-9.]+", " ", s.lower()).strip(" ."))
    found = []
    for sentence in re.split(r"(?<=[.!?;:])(?<!\bv\.)\s+|\n\s*\n", text.lower()):
        lines, at = sentence.split("\n"), 0
        while at < len(lines):
            ends = [e for e in range(len(lines), at, -1) if plain("\n".join(lines[at:e])) in table and plain(lines[e - 1])]
            if ends:
                found.append(table[plain("\n".join(lines[at : ends[0]]))])
            at = ends[0] if ends else at + 1
    return found


def planted(rng, sentence):
    """The sentence in some case, perhaps wrapped, commented, with or without a full stop, between lines of prose."""
    words = [rng.choice((str, str.upper, str.capitalize))(sentence)][0].split(" ")
    mark = rng.choice(("", "# ", " * ", "// "))
    for i in rng.sample(range(1, len(words)), min(rng.randrange(3), len(words) - 1)):
        words[i] = "\n" + mark + words[i]
    prose = lambda: rng.choice(("", "thon erre\n", "thon erre.\n", "er ***\n", "er ein, und\n\n"))
    return prose() + mark + re.sub(r" \n", "\n", " ".join(words)) + rng.choice(("", ".", "!")) + "\n" + prose()


def test_sentences_against_brute_force(docs):
    rng = random.Random(4)
    known = list(licences.sentence_ids())
    texts = ["".join(planted(rng, s) for s in rng.sample(known, rng.randint(1, 3))) for _ in range(300)]
    texts += [planted(rng, s) for s in licences.SENTENCES]
    rows = {r.doc_id: r for r in licences.licence_scan(docs(*texts)).collect()}
    want = [slow_known(t) for t in texts]
    assert [rows[i].n_known for i in range(len(texts))] == [len(w) for w in want] and all(want)


@pytest.mark.parametrize("text, want", [
    ("thonhare.***\nLicensed under CC BY-NC 4.0.", ("CC-BY-NC-4.0", 1, 0)),
    ("enerach enerach\nAll rights reserved.", ("All-rights-reserved", 1, 0)),
    ("All rights reserved\nenerach enerach", ("All-rights-reserved", 1, 0)),
    ("erre\nThis work is licensed\n under the MIT License\nund so", ("MIT", 1, 0)),
    ("All rights\nreserved", ("All-rights-reserved", 1, 0)),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("MPL-2.0", 1, 0)),
    ("Ask for a permission\nto enter. More", ("", 0, 1)),
])
def test_lines_end_sentences(docs, text, want):
    row = licences.licence_scan(docs(text)).first()
    assert (row.licences, row.n_known, row.n_unknown) == want


def test_every_known_sentence_is_found(docs):
    assert all(any(stem in s for stem in licences.STEMS) for s in licences.sentence_ids())
    known = [f(s) for s in licences.sentence_ids() for f in (str, str.upper, str.title)]
    assert licences.licence_scan(docs(*known)).filter("n_known <> 1 or n_unknown <> 0").isEmpty()


@pytest.mark.parametrize("text, want", [
    ("Released under CC BY 4.0", "CC-BY-4.0"), ("Distributed under CC0 1.0.", "CC0-1.0"),
    ("This work is available under\nCC BY-SA 4.0.", "CC-BY-SA-4.0"), ("made available under CC BY-NC 4.0", "CC-BY-NC-4.0"),
    ("aLL RigHTS reserved", "All-rights-reserved"),
])
def test_grants_without_the_word_licence(docs, text, want):
    assert licences.licence_scan(docs(text)).first().licences == want
