"""The registered queries of this subpackage: each applies one operator to its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketwork.llm import (
    decontamination, html_text, licences, mixing, periodic_runs, pseudonyms, quality_rules, sharding, simhash, token_alignment, token_counts, toxicity,
    web_archive,
)
from basketwork.llm.common import let, scratch, table, words


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.sharded(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "shard_id", "shard_depth")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the tokens, raked within what the cells hold, as in the pipeline."""
    rows = mixing.mixture(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "selected")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a new, empty cache, so that every distinct content is encoded here."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), scratch(spark, "token-cache"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pseudonyms.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), "key of the registered query")
    return rows.select("doc_id", "text", F.array_join("pii_kinds", ",").alias("pii_kinds"), F.size("pii_kinds").cast("long").alias("n_pii"))


def planted_period(doc_id: Column, text: Column) -> Column:
    """The text of op11: one document in ten repeats a stretch of its words to its end; others stay as they are."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        copies = F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int"))
        tail = F.slice(F.flatten(copies), F.lit(1), n - a)
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " "))

    return F.when(h % 10 == 0, let(words(text), repeated)).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted_period(F.col("doc_id"), F.col("text")).alias("text"))
    # longest first; of equal length the smallest start, then the smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    rows = periodic_runs.periodic_runs(docs).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return rows.select(
        "doc_id", "n_runs", (-F.col("best.col2")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.col3")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.col3")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


def op12_web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives every page, then finds each by its URL and id in the index and reads its record back."""
    pages, folder = table(spark, sf_dir, "pages"), scratch(spark, "web-archive")
    _, shards = web_archive.archive(pages, folder)
    rows = web_archive.lookup(pages.select("url", "page_id"), folder, shards, with_payload=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.link_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licences": op1_licences,
    "op2_simhash": op2_simhash,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_sharding": op5_sharding,
    "op6_mixing": op6_mixing,
    "op7_html_text": op7_html_text,
    "op8_token_counts": op8_token_counts,
    "op9_quality_rules": op9_quality_rules,
    "op10_pseudonyms": op10_pseudonyms,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_web_archive": op12_web_archive,
    "op13_token_alignment": op13_token_alignment,
}
