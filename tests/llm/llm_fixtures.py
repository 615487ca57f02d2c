from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """`docs(text, ...)` or `docs((id, text), ...)`: a documents frame; ids count from 0."""

    def make(*rows, schema: str = DOCS, more: tuple = ()):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, "en", f"s{k % 3}", len(t) if t is not None else None, *more) for k, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def odd(docs):
    """Null, empty, blank and long texts, a repeated row, a null id, and columns with clashing names."""
    schema = DOCS + ", shard_id string, score double, key string, fp long, _kept string, n string"
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one two three " * 4000), (4, "a b c"), (4, "a b c"), (None, "a b c"), (None, None)]
    return docs(*rows, schema=schema, more=("x", 1.0, "k", 7, "z", "n"))
