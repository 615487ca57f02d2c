"""Operators and stages on tables whose extra columns carry every name that the operators use inside."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketwork.llm import (
    decontamination, html_text, licences, mixing, periodic_runs, pseudonyms, quality_rules, simhash, token_alignment,
    token_counts, toxicity, web_archive,
)
from llm_fixtures import docs, odd  # noqa: F401

FOLDER = Path(corpus_pipeline.__file__).parent / "basketwork/llm"
OWN = {"doc_id", "text", "lang", "source", "n_chars", "topic", "page_id", "url", "html"}


def internal_names() -> list[str]:
    """Every quoted word in the sources that could be a column's name."""
    found = set()
    for file in FOLDER.glob("*.py"):
        found |= set(re.findall(r"[\"']([a-z_][a-z0-9_]{0,20})[\"']", file.read_text()))
        found |= set(re.findall(r"\b(_[a-z]+)\b", file.read_text()))
    return sorted(found - OWN)


NAMES = internal_names()
TEXTS = ["one two three four five six seven eight nine ten eleven twelve. " * 2, "a b c", None, "", "License: MIT. all about it, and more words than ten here for once", "a b c"]


@pytest.fixture(scope="module")
def clashing(docs):
    return docs(*TEXTS).select("*", *(F.lit("mine").alias(n) for n in NAMES))


def test_names_are_found():
    assert {"_row", "_own", "_digest", "_text", "_depth", "_source", "_tokens", "node", "fp", "key", "digest"} <= set(NAMES)


def same(df, kept_from, results: set[str]) -> None:
    """All rows' other columns come back as they were."""
    rows = df.collect()
    assert set(kept_from.columns) <= set(df.columns)
    for r in rows:
        assert all(r[n] == "mine" for n in NAMES if n not in results)


CARRIERS = {
    "without_near_duplicates": (simhash.without_near_duplicates, set()),
    "mixture": (mixing.mixture, {"n_tokens", "topic", "probability", "selected"}),
    "pseudonymised": (lambda d: pseudonyms.pseudonymised(d, "key"), {"pii_kinds"}),
}


@pytest.mark.parametrize("name", sorted(CARRIERS))
def test_carried_columns_come_back(clashing, docs, name):
    operator, results = CARRIERS[name]
    got, plain = operator(clashing), operator(docs(*TEXTS))
    same(got, clashing, results)
    key = lambda df: sorted(str((r.doc_id, r.text)) for r in df.collect())
    assert key(got) == key(plain)


def test_decontaminated(spark, clashing):
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve")], "item_id long, text string")
    more = benchmark.select("*", *(F.lit("x").alias(n) for n in NAMES if n != "item_id"))
    got = decontamination.decontaminated(clashing, more)
    same(got, clashing, set())
    assert sorted(r.doc_id for r in got.collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("name", ["licences", "simhash", "runs", "alignment", "counts", "quality"])
def test_reports_ignore_other_columns(clashing, docs, name, tmp_path):
    operator = {
        "licences": licences.licence_scan, "simhash": simhash.near_duplicates, "runs": periodic_runs.periodic_runs,
        "alignment": token_alignment.link_report, "quality": quality_rules.quality_report,
        "counts": lambda d: token_counts.token_counts(d, str(tmp_path / str(len(d.columns)))),
    }[name]
    rows = [sorted(map(str, operator(d).collect())) for d in (clashing, docs(*TEXTS))]
    assert rows[0] == rows[1] and len(rows[0]) == len(TEXTS)


def test_pages(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/x", "<p>one</p><p>two</p>"), (2, "http://a/y", "<p>one</p>")], "page_id long, url string, html string")
    more = pages.select("*", *(F.lit("mine").alias(n) for n in NAMES))
    assert sorted(map(str, html_text.extracted(more).collect())) == sorted(map(str, html_text.extracted(pages).collect()))
    _, files = web_archive.archive(more, str(tmp_path / "a"))
    assert web_archive.lookup(more, str(tmp_path / "a"), files).count() == 2


def test_toxicity(spark, docs):
    texts = [f"{'vile hateful scum' if i % 3 == 0 else 'kind calm words'} number {i}." for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    more = docs(*texts).select("*", *(F.lit("mine").alias(n) for n in NAMES))
    assert toxicity.toxicity(more, labels).count() == 60


def test_stages_keep_the_columns(spark, clashing, tmp_path):
    spark.createDataFrame([(1, "nothing of this occurs anywhere else")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, clashing, str(tmp_path))
        same(out, clashing, {"n_bytes", "shard_id", "shard_depth"} if name == "shard" else set())


@pytest.mark.parametrize("which", ["odd", "empty"])
def test_stages_on_odd_and_empty_tables(spark, odd, docs, tmp_path, which):
    spark.createDataFrame([(1, "one two three one two three")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = odd if which == "odd" else docs()
    if which == "odd":  # every stage on the odd table itself: its quality rules alone would leave nothing
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, str(tmp_path))
            assert (out.columns == frame.columns or name == "shard") and out.count() <= frame.count()
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
