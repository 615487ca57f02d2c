from __future__ import annotations

import pytest
from tokenizers import Tokenizer

from basketwork.llm import token_counts as t
from llm_fixtures import docs, odd  # noqa: F401

TEXTS = ["Hello  world", "Hello\nworld ", None, "", "éà I'll don't 12345 ---", "<|endoftext|> in text<|endoftext|>x", "é İ ΣΑΣ ſt", "x" * 30_000, "word " * 3000, "　wide space"]


def test_counts_and_cache(spark, docs, tmp_path):
    cache = str(tmp_path / "cache")
    library = Tokenizer.from_file(t.tokenizer_file(t.TOKENIZER))
    for _ in range(2):
        rows = {r.doc_id: r for r in t.token_counts(docs(*TEXTS), cache).collect()}
        for i, text in enumerate(TEXTS):
            want = len(library.encode(text or "", add_special_tokens=False).ids)
            assert (rows[i].n_tokens, rows[i].n_bytes, rows[i].over_limit) == (want, len((text or "").encode()), want > 2048)
    stored = spark.read.parquet(cache)
    # texts 0 and 1, and 2 and 3, are one content each; the second run found all of them
    assert stored.count() == len(TEXTS) - 2 == stored.select("digest").distinct().count()
    t.token_counts(docs("Hello world", "something new"), cache).count()
    assert spark.read.parquet(cache).count() == len(TEXTS) - 1


def test_another_version_is_another_entry(spark, docs, tmp_path):
    cache = str(tmp_path / "cache")
    other = t.tokenizer_file("byte_bpe_50k.json")
    with pytest.raises(ValueError, match="white space"):
        t.token_counts(docs("a b"), cache, other)


def test_odd_and_empty(odd, docs, tmp_path):
    assert t.token_counts(odd, str(tmp_path / "a")).count() == 8
    assert t.token_counts(docs(), str(tmp_path / "b")).count() == 0
