"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learnt from document labels."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketwork.llm.sharding import hash_bits

# The fit reads at most so many labelled documents of each label, chosen by the hash of their id.
MAX_TOXIC, MAX_CLEAN = 2000, 3000
FEATURE_BITS = 18
PREFIXES = (3, 4, 5)
ROUNDS = 60
MEMO_WORDS = 200_000
# A feature is learnt if toxic documents hold it more often than chance by so many deviations.
LEAST_DEVIATION, LEAST_TOXIC = 3.0, 3
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    """Hashed features of a lower-case word: itself and its beginnings."""
    mask = (1 << FEATURE_BITS) - 1
    return [zlib.crc32(f"={word}".encode()) & mask, *(zlib.crc32(word[:n].encode()) & mask for n in PREFIXES if len(word) >= n)]


@dataclass
class Model:
    bias: float
    weights: np.ndarray

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Scores sentences and documents; sums of words seen before are remembered, up to a bound."""

    def __init__(self, model: Model):
        self.model, self.memo = model, {}

    def _word(self, word: str) -> float:
        value = self.memo.get(word)
        if value is None:
            if len(self.memo) > MEMO_WORDS:
                self.memo.clear()
            value = self.memo[word] = float(self.model.weights[word_features(word)].sum())
        return value

    def sentences(self, text: str | None) -> list[tuple[int, int, float]]:
        """Start, end and probability of every sentence with words."""
        found = []
        for m in _SENTENCE.finditer(text or ""):
            words = _WORD.findall(m[0].lower())
            if words:
                z = self.model.bias + sum(map(self._word, words))
                found.append((m.start(), m.end(), 1 / (1 + float(np.exp(-min(max(z, -50.0), 50.0))))))
        return found


def noisy_or(probabilities: list[float]) -> float:
    """Probability that at least one sentence is toxic."""
    return float(-np.expm1(np.log1p(-np.minimum(probabilities, 1 - 1e-12)).sum())) if probabilities else 0.0


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learnt: crc32 of the id as text is divisible by 5. False for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_ids(labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> tuple[DataFrame, float]:
    """doc_id, toxic of the bounded sample, and the weight of a clean document that restores the corpus's odds."""
    rows = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    counts = dict(rows.groupBy("toxic").count().collect())
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    draw = hash_bits(F.concat(F.lit("fit:"), F.col("doc_id").cast("string")))
    parts = [rows.filter(F.col("toxic") == t).orderBy(draw, "doc_id").limit(n) for t, n in ((1, max_toxic), (0, max_clean))]
    used_toxic, used_clean = min(toxic, max_toxic), min(clean, max_clean)
    weight = (clean / used_clean) / (toxic / used_toxic) if used_toxic and used_clean else 1.0
    return parts[0].union(parts[1]), weight


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """toxic, sizes (features of each sentence), features (of all sentences) of every document."""
    memo: dict[str, list[int]] = {}
    for batch in batches:
        sizes, features = [], []
        for text in batch["text"]:
            own, all_ = [], []
            for m in _SENTENCE.finditer(text.as_py() or ""):
                found = []
                for w in set(_WORD.findall(m[0].lower())):
                    if w not in memo:
                        if len(memo) > MEMO_WORDS:
                            memo.clear()
                        memo[w] = word_features(w)
                    found += memo[w]
                if found:
                    own.append(len(found))
                    all_ += found
            sizes.append(own)
            features.append(all_)
        kinds = pa.list_(pa.int32())
        yield pa.record_batch([batch["toxic"], pa.array(sizes, kinds), pa.array(features, kinds)], ["toxic", "sizes", "features"])


def telling(label: np.ndarray, doc_of: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Which features mark toxic documents in this sample: counts of documents, not of words."""
    pairs = np.unique((doc_of.astype(np.int64) << FEATURE_BITS) | features)
    feature, of_toxic = pairs & ((1 << FEATURE_BITS) - 1), label[pairs >> FEATURE_BITS]
    all_ = np.bincount(feature, minlength=1 << FEATURE_BITS)
    seen = np.bincount(feature[of_toxic], minlength=1 << FEATURE_BITS)
    expected = np.maximum(all_ * label.mean(), 1e-9)
    return (seen >= LEAST_TOXIC) & ((seen - expected) / np.sqrt(expected) >= LEAST_DEVIATION)


def fitted(toxic: np.ndarray, sizes: list[np.ndarray], features: np.ndarray, clean_weight: float = 1.0, rounds: int = ROUNDS) -> Model:
    """A logistic sentence model under noisy-or over `telling` features, by adaptive gradient steps.

    Loss of a document with sentence probabilities s: -log of 1 - prod(1 - s) if toxic, else
    -log of prod(1 - s). Without documents of both labels all sentences get the same low score.
    """
    weights, bias = np.zeros(1 << FEATURE_BITS, np.float32), -6.0
    per_doc = np.array([len(s) for s in sizes])
    use = per_doc > 0
    if not use.any() or len(set(toxic[use])) < 2:
        return Model(bias, weights)
    lengths = np.concatenate([s for s in sizes if len(s)])
    starts, doc_starts = np.r_[0, np.cumsum(lengths)[:-1]], np.r_[0, np.cumsum(per_doc[use])[:-1]]
    label = toxic[use].astype(bool)
    doc_of = np.repeat(np.repeat(np.arange(len(label)), per_doc[use]), lengths)
    active = telling(label, doc_of, features)
    importance = np.where(label, 1.0, clean_weight) / len(label)
    sum_w, sum_b = np.full(len(weights), 1e-10, np.float64), 1e-10
    for _ in range(rounds):
        z = np.add.reduceat(weights[features], starts).astype(np.float64) + bias
        s = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        none = np.exp(-np.add.reduceat(np.logaddexp(0, z), doc_starts))
        slope = np.where(label, -none / np.maximum(1 - none, 1e-9), 1.0) * importance
        d = np.repeat(slope, per_doc[use]) * s
        gradient = np.bincount(features, np.repeat(d, lengths), len(weights)) * active + 1e-6 * weights
        sum_w += gradient**2
        sum_b += d.sum() ** 2
        weights -= (0.5 * gradient / np.sqrt(sum_w)).astype(np.float32)
        bias -= 0.1 * d.sum() / np.sqrt(sum_b)
    return Model(bias, weights)


def learnt(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Model:
    """A model from a bounded sample of the labelled documents that are not held out.

    The sample's ids are at most `max_toxic` + `max_clean` rows, so they are broadcast; its
    features, made on the executors from whole texts, are bounded by them and come to the driver.
    """
    ids, weight = training_ids(labels, max_toxic, max_clean)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = texts.join(F.broadcast(ids), "doc_id").select("toxic", "text")
    rows = chosen.mapInArrow(_features, "toxic int, sizes array<int>, features array<int>").toArrow()
    if not rows.num_rows:
        return Model(-6.0, np.zeros(1 << FEATURE_BITS, np.float32))
    sizes = [np.array(s.values) for s in rows["sizes"]]
    return fitted(rows["toxic"].to_numpy(), sizes, rows["features"].combine_chunks().flatten().to_numpy(), weight)


SCORES = "doc_id long, score double, worst_start int, worst_end int, worst_score double, n_offending int"


def _scores(model: Model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = scorer.sentences(text.as_py())
                worst = max(found, key=lambda x: (x[2], -x[0]), default=(None, None, None))
                rows.append((noisy_or([p for *_, p in found]), *worst, sum(p >= threshold for *_, p in found)))
            types = (pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.int32())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, types)]
            names = ["doc_id", "score", "worst_start", "worst_end", "worst_score", "n_offending"]
            yield pa.record_batch([batch["doc_id"], *columns], names)

    return run


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from `threshold` on), and the worst sentence of every row.

    The sentence model is `learnt`; score is the noisy-or of all sentences of the whole text,
    worst_start and worst_end are the characters of the sentence with the highest score,
    n_offending counts sentences at or above `threshold`. Only the text is scored. Null, empty
    and wordless texts have score 0 and no worst sentence. A document labelled twice counts as
    toxic if one label says so; labels without id or value are not learnt. Rows are kept as they
    are, repeated and null ids included; other columns are ignored; empty tables give no rows,
    and without labels of both kinds every sentence gets the same low score.
    """
    model = learnt(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = rows.mapInArrow(_scores(model, threshold), SCORES)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "worst_start", "worst_end", "worst_score", "n_offending",
    )
