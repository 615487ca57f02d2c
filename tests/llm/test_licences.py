from __future__ import annotations

import pytest

from basketwork.llm import licences
from llm_fixtures import docs, odd  # noqa: F401

APACHE = '# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance\n# with the License. You may obtain a copy of the License at\n\nhttp://x'
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
 * Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
 * Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
NAMES = "\n * Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."


@pytest.mark.parametrize("text, want", [
    ("Released under the MIT License. More text.", ("MIT", 1, 0)),
    ("Words.\nThis work is licensed under the GNU General Public License, version 3.", ("GPL-3.0", 1, 0)),
    ("Licensed under CC BY-NC 4.0.\nAll rights reserved.", ("CC-BY-NC-4.0 AND All-rights-reserved", 2, 0)),
    (APACHE, ("Apache-2.0", 3, 0)), (BSD, ("BSD-2-Clause", 3, 0)), (BSD + NAMES, ("BSD-3-Clause", 4, 0)),
    ("A driving licence is a permission to drive.", ("", 0, 1)), ("No stems here.", ("", 0, 0)), ("", ("", 0, 0)), (None, ("", 0, 0)),
])
def test_scan(docs, text, want):
    row = licences.licence_scan(docs(text)).first()
    assert (row.licences, row.n_known, row.n_unknown) == want


def test_every_known_sentence_has_a_rule_and_a_stem():
    parts = {i for seq, _ in licences.rules() for i in seq.strip(",").split(",,")}
    ids = set(licences.sentence_ids().values())
    assert parts <= ids and ids - parts == set()
    assert all(any(stem.lower() in s for stem in licences.STEMS) for s in licences.sentence_ids() if "cc" not in s[-16:] and "cc0" not in s)


def test_odd_and_empty(odd, docs):
    assert licences.licence_scan(odd).count() == 8 and licences.licence_scan(docs()).count() == 0
