"""Token counts through a digest cache: only contents that the cache lacks are encoded."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKENIZER = "word_bpe_49k.json"
CACHE = "tokenizer string, digest binary, n_tokens long"
MEMO_WORDS = 400_000


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file: another file is another version."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def drops_white_space(path: str) -> None:
    """Refuse tokenizers to which white space matters: words and normal form would then not be enough."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    one, two = (tokenizer.encode(text, add_special_tokens=False).ids for text in ("a b", " a \n b "))
    apart = [i for word in ("a", "b") for i in tokenizer.encode(word, add_special_tokens=False).ids]
    if not one == two == apart:
        raise ValueError("the tokenizer keeps white space")


def normalised(text: Column) -> Column:
    """Content whose digest is looked up: runs of ASCII white space are one blank, ends are trimmed.

    The tokenizer drops white space, so texts that are equal then have equal counts.
    """
    return F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[ \\t-\\r]+", " "))


class TokenCounter:
    """Counts tokens of a text as the library does, without added special tokens.

    Tokens never span white space here, so a text has the tokens of its words; words seen before
    are remembered; beyond `MEMO_WORDS` of them the memory starts anew.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[bytes, int] = {}

    def counts(self, texts: list[bytes]) -> list[int]:
        split = [t.split() for t in texts]
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        new = list({w for words in split for w in words if w not in self.memo})
        for i in range(0, len(new), 5000):
            part = new[i : i + 5000]
            encoded = self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            self.memo.update(zip(part, map(len, encoded)))
        return [sum(map(self.memo.__getitem__, words)) for words in split]


@lru_cache(maxsize=1)
def _counter(path: str, version: str) -> TokenCounter:
    """One for each Python worker, which runs many tasks."""
    return TokenCounter(path)


def _encoder(path: str, version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, version)
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.slice(start, 500)
                counts = counter.counts([t.as_buffer().to_pybytes() for t in part["content"]])
                yield pa.record_batch([part["digest"], pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return run


def _read_cache(docs: DataFrame, cache: str, version: str) -> DataFrame:
    """digest, n_tokens of this tokenizer version; no rows if the cache does not exist yet."""
    spark = docs.sparkSession
    try:
        rows = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE)
    return rows.filter(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, cache: str, tokenizer: str | None = None, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > `limit`) of every row.

    `cache` is a folder in storage that all executors share, partitioned by tokenizer version;
    it is created at need. Contents are looked up by digest; each distinct content without an
    entry is encoded once, whole, and appended. Null text is an empty text with 0 tokens. Rows
    are kept as they are, repeated and null ids included; other columns are ignored; an empty
    table gives an empty result and leaves the cache as it is. `tokenizer` is a file that every
    executor can read, the 49k word BPE by default; one to which white space matters is refused.
    """
    path = tokenizer or tokenizer_file(TOKENIZER)
    drops_white_space(path)
    version = tokenizer_version(path)
    content = normalised(F.col("text"))
    digest = F.unhex(F.sha2(content, 256)).alias("digest")
    misses = (
        docs.select(digest, content.alias("content"))
        .dropDuplicates(["digest"])
        .join(_read_cache(docs, cache, version), "digest", "left_anti")
    )
    encoded = misses.mapInArrow(_encoder(path, version), "digest binary, n_tokens long")
    encoded.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)
    rows = docs.select("doc_id", F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("n_bytes"), digest)
    return rows.join(_read_cache(docs, cache, version), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
