"""Licence scans: known sentences become identifiers, sequences of identifiers match ordered rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Licences by the names that grants use, after `normalised`.
NAMES = {
    "mit license": "MIT", "apache license version 2.0": "Apache-2.0", "apache license 2.0": "Apache-2.0",
    "gnu general public license version 2": "GPL-2.0", "gnu general public license version 3": "GPL-3.0",
    "gnu lesser general public license version 2.1": "LGPL-2.1", "gnu lesser general public license version 3": "LGPL-3.0",
    "gnu affero general public license version 3": "AGPL-3.0", "mozilla public license version 2.0": "MPL-2.0",
    "eclipse public license version 2.0": "EPL-2.0", "boost software license version 1.0": "BSL-1.0",
    "isc license": "ISC", "bsd 2 clause license": "BSD-2-Clause", "bsd 3 clause license": "BSD-3-Clause",
    "cc0 1.0": "CC0-1.0", "cc by 4.0": "CC-BY-4.0", "cc by sa 4.0": "CC-BY-SA-4.0", "cc by nd 4.0": "CC-BY-ND-4.0",
    "cc by nc 4.0": "CC-BY-NC-4.0", "cc by nc sa 4.0": "CC-BY-NC-SA-4.0", "cc by nc nd 4.0": "CC-BY-NC-ND-4.0",
}
SUBJECTS = ("", "this work is ", "this software is ", "this program is ", "this file is ", "this project is ", "the code is ")
VERBS = ("licensed under ", "released under ", "distributed under ", "available under ", "made available under ")

# Sentences of licence texts and notices, after `normalised`.
SENTENCES = {
    "all rights reserved": "reserved",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "licensed under the apache license version 2.0 the license": "apache-grant",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may obtain a copy of the license at": "apache-copy",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-or-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-or-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "this source code form is subject to the terms of the mozilla public license v. 2.0": "mpl-notice",
}
# Rules in order; an earlier rule takes its identifiers from later ones.
TEXT_RULES = (
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("mit-grant", "mit-notice", "mit-warranty"), "MIT"),
    (("mit-grant", "mit-notice"), "MIT"),
    (("isc-grant",), "ISC"),
    (("apache-grant", "apache-comply", "apache-copy"), "Apache-2.0"),
    (("apache-grant",), "Apache-2.0"),
    (("gpl3-or-later", "gpl-warranty"), "GPL-3.0-or-later"),
    (("gpl3-or-later",), "GPL-3.0-or-later"),
    (("gpl2-or-later", "gpl-warranty"), "GPL-2.0-or-later"),
    (("gpl2-or-later",), "GPL-2.0-or-later"),
    (("mpl-notice",), "MPL-2.0"),
)
# A sentence that is not known and holds none of these stems, after `normalised`, is no licence sentence.
STEMS = ("icen", "ights reserved", "ermission", "edistribut", "arrant", "opyright notice", "under cc", "under the cc")
# Marks the end of a sentence in `normalised` text; line breaks stay line breaks.
END = "\x01"


def sentence_ids() -> dict[str, str]:
    """Identifier of every known sentence; grants are made from subjects, verbs and names."""
    grants = {
        f"{subject}{verb}{the}{name}": f"grant-{licence}"
        for subject in SUBJECTS for verb in VERBS for the in ("", "the ") for name, licence in NAMES.items()
    }
    return grants | SENTENCES


def rules() -> list[tuple[str, str]]:
    """Identifier sequence, written `,a,b,`, and licence, in order."""
    grants = [((f"grant-{licence}",), licence) for licence in dict.fromkeys(NAMES.values())]
    reserved = [(("reserved",), "All-rights-reserved")]
    return [(f",{',,'.join(ids)},", licence) for ids, licence in (*TEXT_RULES, *grants, *reserved)]


def has_stem(plain: Column) -> Column:
    found = plain.contains(STEMS[0])
    for stem in STEMS[1:]:
        found = found | plain.contains(stem)
    return found


def hinted(text: Column) -> Column:
    """Whether a text as it is written may hold a stem."""
    return text.rlike("(?i)" + "|".join(stem.replace(" ", "[^a-z0-9]+") for stem in STEMS))


def normalised(text: Column) -> Column:
    """Lower case, comment marks and punctuation as one blank, no full stops or blanks at the ends of lines.

    Sentences end at `.`, `!`, `?`, `;` or `:` before white space, and at blank lines;
    `v.` ends none.
    """
    ended = F.regexp_replace(F.lower(F.translate(text, END, " ")), r"(?<=[.!?;:])(?<!\bv\.)\s+|\n\s*\n", END)
    plain = F.regexp_replace(ended, f"[^a-z0-9.\n{END}]+", " ")
    lines = F.regexp_replace(plain, r"^[ .]+|[ .]+$|[ .]*\n[ .\n]*", "\n")
    return F.regexp_replace(lines, f"[ .\n]*{END}[ .\n{END}]*", END)


def _gaps(sentence: str) -> str:
    """A known sentence as a pattern: its words may be parted by line breaks, which take a full stop away."""
    return re.sub(r"(\\\.)?\\? ", lambda m: r"\.?[ \n]" if m[1] else r"[ \n]", re.escape(sentence))


def known_pattern() -> str:
    """Every known sentence, from the start of a line or sentence to the end of one; the longest first."""
    options = lambda parts: "|".join(_gaps(p) for p in sorted(parts, key=len, reverse=True))
    grant = rf"(?:{options(SUBJECTS)})(?:{options(VERBS)})(?:the[ \n])?(?:{options(NAMES)})"
    return rf"(?<![^\n{END}])({options(SENTENCES)}|{grant})(?![^\n{END}])"


def _identified(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order; `unknown` for what is left of a sentence and has a stem."""
    table = F.create_map(*(F.lit(x) for s, i in sentence_ids().items() for x in (s.replace(". ", " "), i)))
    pieces = F.split(F.regexp_replace(normalised(text), known_pattern(), f"{END}=$1{END}"), END)
    sentence = lambda p: F.regexp_replace(F.substr(p, F.lit(2)), rf"\.?[ \n]", " ")
    named = lambda p: F.when(p.startswith("="), F.try_element_at(table, sentence(p))).when(has_stem(F.translate(p, "\n", " ")), "unknown")
    return F.filter(F.transform(pieces, named), lambda i: i.isNotNull())


def _matched(ids: Column) -> Column:
    """struct(rest, found): licences of the matched rules, in the rules' order."""
    table = F.array(*(F.struct(F.lit(seq).alias("seq"), F.lit(licence).alias("licence")) for seq, licence in rules()))
    start = F.struct(
        F.concat(F.lit(","), F.array_join(ids, ",,"), F.lit(",")).alias("rest"), F.array().cast("array<string>").alias("found")
    )

    def step(s: Column, rule: Column) -> Column:
        hit = s["rest"].contains(rule["seq"])
        return F.struct(
            F.when(hit, F.replace(s["rest"], rule["seq"], F.lit(";"))).otherwise(s["rest"]).alias("rest"),
            F.when(hit, F.array_append(s["found"], rule["licence"])).otherwise(s["found"]).alias("found"),
        )

    return F.aggregate(table, start, step)


def licence_scan(docs: DataFrame) -> DataFrame:
    """doc_id, licences (in rule order, joined by ` AND `, empty if none), n_known, n_unknown of every row.

    Known sentences are found in normalised text wherever they reach from the start of a line or
    sentence to the end of one, over any number of line breaks, with or without full stops. What
    is left of a sentence and has a licence stem counts as unknown and breaks a sequence. The identifiers of a document, in order, are matched
    against the rules from the first to the last; what a rule matches is taken from later rules.
    Null and empty texts have no sentences. Rows are kept as they are, repeated and null ids
    included; other columns are ignored; an empty table gives none. No shuffle.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.when(hinted(text), _identified(text)).alias("ids"))
    known = F.size(F.filter("ids", lambda i: i != "unknown"))
    licences = F.when(known > 0, F.array_join(F.array_distinct(_matched(F.col("ids"))["found"]), " AND ")).otherwise("")
    return rows.select(
        "doc_id", F.coalesce(licences, F.lit("")).alias("licences"),
        F.when(F.col("ids").isNull(), 0).otherwise(known).cast("long").alias("n_known"),
        F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids") - known).cast("long").alias("n_unknown"),
    )
