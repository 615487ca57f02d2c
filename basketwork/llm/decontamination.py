"""Benchmark decontamination: CGK embedding, bit-sampling LSH over windows, exact edit distance."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketwork.llm.common import carried, restored

SIMILARITY = 0.8
# Items of fewer words are found through pieces: an item cut into one piece more than it may have edits keeps one whole.
SHORT_WORDS = 12
BLOCK_ITEMS = 20_000
CHUNK_WORDS = 150_000
# Bit samples of the embedding: embedding, steps of its random walk, sampled steps. A walk of 8
# steps sees four to five words. Measured recall is in the README and in the tests.
TABLES = ((0, 8, 7), (1, 8, 7), (2, 8, 7), (3, 8, 7), (4, 8, 7))
LEAST_PASSED = 3
SEED = 20240229
_BITMAP_BITS = 20
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters and digits."""
    return _WORD.findall(text.lower()) if text else []


def budget(n_words: int, similarity: float = SIMILARITY) -> int:
    """Word edits that an item of `n_words` words may have."""
    return int(n_words * (1 - similarity) + 1e-9)


def walk_steps() -> list[np.ndarray]:
    """The steps that each table samples: the first of its walk and others drawn from the rest."""
    random = np.random.default_rng(SEED)
    return [np.sort(np.r_[0, 1 + random.choice(n - 1, k - 1, replace=False)]) for _, n, k in TABLES]


def _walk(ids: np.ndarray, bits: np.ndarray, starts: np.ndarray, steps: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """CGK walks from `starts`: at each step put out the word, then move on if its random bit is set.

    Also how many words each walk has passed at each step.
    """
    at, out, passed = starts.copy(), [], []
    for t in range(steps):
        word = ids[at]
        out.append(word)
        passed.append((at - starts).astype(np.int8))
        at += (bits[word] >> t) & 1
    return out, passed


def _keys(out: list[np.ndarray], steps: np.ndarray, factors: np.ndarray) -> np.ndarray:
    key = np.zeros(len(out[0]), dtype=np.uint64)
    for t, f in zip(steps, factors):
        key += out[t].astype(np.uint64) * f
    return key ^ (key >> np.uint64(29))


@dataclass
class Item:
    item_id: object
    words: list[str]
    masks: dict[str, int] = field(default_factory=dict)
    reverse_masks: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for i, w in enumerate(self.words):
            self.masks[w] = self.masks.get(w, 0) | 1 << i
            self.reverse_masks[w] = self.reverse_masks.get(w, 0) | 1 << (len(self.words) - 1 - i)


def best_end(masks: dict[str, int], length: int, region: list[str], anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of a pattern to any part of `region`, and where that part ends first.

    Bit-parallel, a word at a time. `anchored`: the part starts where the region does.
    """
    ones = (1 << length) - 1
    top, plus, minus, score = 1 << (length - 1), ones, 0, length
    best, end = length, 0
    for i, word in enumerate(region):
        equal = masks.get(word, 0)
        x = equal | minus
        diagonal = ((((equal & plus) + plus) ^ plus) | equal) & ones
        h_plus, h_minus = (minus | ~(diagonal | plus)) & ones, plus & diagonal
        score += bool(h_plus & top) - bool(h_minus & top)
        h_plus, h_minus = (h_plus << 1) | anchored, h_minus << 1
        plus, minus = (h_minus | ~(x | h_plus)) & ones, h_plus & x & ones
        if score < best:
            best, end = score, i + 1
    return best, end


class Matcher:
    """Finds the items of one block of the benchmark in documents."""

    def __init__(self, items: list[tuple[object, str | None]], similarity: float = SIMILARITY):
        self.similarity = similarity
        listed = [Item(i, words_of(t)) for i, t in items]
        self.items = [x for x in listed if x.words]
        self.vocabulary = {w: n for n, w in enumerate(sorted({w for x in self.items for w in x.words}), 1)}
        self.end = len(self.vocabulary) + 1
        random = np.random.default_rng(SEED)
        # bits of the words outside the vocabulary (0) and of the end mark are drawn as well
        self.bits = random.integers(0, 1 << 31, (1 + max(e for e, *_ in TABLES), self.end + 1), dtype=np.int32)
        self.steps = walk_steps()
        self.longest = max(length for _, length, _ in TABLES)
        self.factors = random.integers(1, 1 << 62, (len(TABLES), self.longest), dtype=np.uint64) | np.uint64(1)
        self._index()

    def _index(self) -> None:
        """Keys of every window of the items, whole or begun at a later word, table by table."""
        gap = [self.end] * self.longest
        flat, item, offset = [self.end], [-1], [-1]
        for n, x in enumerate(self.items):
            if len(x.words) < SHORT_WORDS:
                continue
            flat += [self.vocabulary[w] for w in x.words] + gap
            item += [n] * len(x.words) + [-1] * self.longest
            offset += [*range(len(x.words)), *([-1] * self.longest)]
        ids, item, offset = np.array(flat, np.int32), np.array(item), np.array(offset)
        starts = np.flatnonzero(item >= 0).astype(np.int32)
        self.tables = []
        for n, key, valid in self._table_keys(ids, starts):
            key, at = key[valid], starts[valid]
            order = np.argsort(key, kind="stable")
            key, at = key[order], at[order]
            bitmap = np.zeros(1 << _BITMAP_BITS, dtype=bool)
            bitmap[(key & np.uint64((1 << _BITMAP_BITS) - 1)).astype(np.int64)] = True
            self.tables.append((key, item[at], offset[at], bitmap))
        self._index_pieces()

    def _index_pieces(self) -> None:
        """Short items cut evenly into one piece more than their budget: sorted keys of all pieces by size."""
        pieces: dict[int, list[tuple[int, int, int]]] = {}
        for n, x in enumerate(self.items):
            if len(x.words) < SHORT_WORDS:
                parts = budget(len(x.words), self.similarity) + 1
                cuts = [len(x.words) * i // parts for i in range(parts + 1)]
                for low, high in zip(cuts, cuts[1:]):
                    ids = np.array([self.vocabulary[w] for w in x.words[low:high]], np.int32)
                    pieces.setdefault(high - low, []).append((int(self._piece_keys(ids, np.zeros(1, np.int64), high - low)[0]), n, low))
        self.pieces = []
        for size, rows in pieces.items():
            rows.sort()
            key, item, offset = (np.array(c, t) for c, t in zip(zip(*rows), (np.uint64, np.int64, np.int64)))
            bitmap = np.zeros(1 << _BITMAP_BITS, dtype=bool)
            bitmap[(key & np.uint64((1 << _BITMAP_BITS) - 1)).astype(np.int64)] = True
            self.pieces.append((size, (key, item, offset, bitmap)))

    def _piece_keys(self, ids: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        return _keys([ids[starts + i] for i in range(size)], np.arange(size), self.factors[0])

    def _lookups(self, ids: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, tuple]]:
        """Keys of the windows at `starts`, which of them can match, and the table to look them up in."""
        if self.tables and len(self.tables[0][0]):
            for n, key, valid in self._table_keys(ids, starts):
                yield key, valid, self.tables[n]
        for size, table in self.pieces:
            # a text ends with more marks than a piece has words
            key, valid = self._piece_keys(ids, starts, size), np.ones(len(starts), bool)
            for i in range(1, size):
                valid &= (ids[starts + i] > 0) & (ids[starts + i] < self.end)
            yield key, valid, table

    def _table_keys(self, ids: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per table: keys of the windows, and which can match.

        Those have only item words at the sampled steps and have passed `LEAST_PASSED` words at
        the last: a walk that stays at one word says too little.
        """
        walks: dict[int, tuple] = {}
        for n, (embedding, *_) in enumerate(TABLES):
            if embedding not in walks:
                need = max(length for e, length, _ in TABLES if e == embedding)
                walks = {embedding: _walk(ids, self.bits[embedding], starts, need)}
            out, passed = walks[embedding]
            valid = passed[self.steps[n][-1]] >= LEAST_PASSED
            for t in self.steps[n]:
                valid &= (out[t] > 0) & (out[t] < self.end)
            yield n, _keys(out, self.steps[n], self.factors[n]), valid

    def _candidates(self, ids: np.ndarray) -> np.ndarray:
        """Distinct rows (item, place of the item's first word in `ids`) whose windows share a key."""
        starts = np.flatnonzero((ids > 0) & (ids < self.end)).astype(np.int32)
        found = [np.empty((0, 2), np.int64)]
        for key, valid, (keys, item, offset, bitmap) in self._lookups(ids, starts):
            hit = np.flatnonzero(valid & bitmap[(key & np.uint64((1 << _BITMAP_BITS) - 1)).astype(np.int64)])
            low, high = np.searchsorted(keys, key[hit], "left"), np.searchsorted(keys, key[hit], "right")
            count = high - low
            if not count.sum():
                continue
            entry = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            found.append(np.stack([item[entry], np.repeat(starts[hit], count) - offset[entry]], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def matches(self, texts: list[str | None]) -> list[dict[int, tuple[int, int, int]]]:
        """Per text: number of the item -> (distance, first word, end word) of its best place."""
        split = [words_of(t) for t in texts]
        result: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        get, first = self.vocabulary.get, 0
        while self.items and first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(split[last]) <= CHUNK_WORDS):
                size += len(split[last]) + self.longest
                last += 1
            begins = np.cumsum([0, *(len(w) + self.longest for w in split[first:last])])
            ids = np.full(begins[-1], self.end, np.int32)
            for w, b in zip(split[first:last], begins):
                ids[b : b + len(w)] = [get(x, 0) for x in w]
            rows = self._candidates(ids)
            # a place may lie before its document begins; the middle of the item never does by much
            lengths = np.array([len(x.words) for x in self.items])
            middle = rows[:, 1] + lengths[rows[:, 0]] // 2
            document = np.clip(np.searchsorted(begins, middle, "right") - 1, 0, last - first - 1)
            for (n, place), d in zip(rows.tolist(), document.tolist()):
                for near in {d, max(0, d - 1), min(last - first - 1, d + 1)}:
                    self._verify(n, place - int(begins[near]), split[first + near], result[first + near])
            first = last
        return result

    def _verify(self, n: int, place: int, words: list[str], result: dict[int, tuple[int, int, int]]) -> None:
        item = self.items[n]
        length, allowed = len(item.words), budget(len(item.words), self.similarity)
        old = result.get(n)
        if old and (old[0] == 0 or abs(old[1] - place) <= allowed):
            return
        low, high = max(0, place - 2 * allowed), min(len(words), place + length + 2 * allowed)
        if high - low < length - allowed:
            return
        region = words[low:high]
        distance, end = best_end(item.masks, length, region)
        if distance <= allowed and (old is None or distance < old[0]):
            _, back = best_end(item.reverse_masks, length, region[:end][::-1], anchored=True)
            result[n] = (distance, low + end - back, low + end)


def _spans(text: str, first: int, end: int) -> tuple[int, int]:
    """Characters of a text from the word `first` up to the word `end`."""
    lower = text.lower()
    at = [m.span() for m in _WORD.finditer(lower)]
    low, high = at[first][0], at[end - 1][1]
    if len(lower) != len(text):  # a few capitals are two characters in lower case
        ends = list(accumulate(len(c.lower()) for c in text))
        low, high = bisect_right(ends, low), bisect_left(ends, high) + 1
    return low, high


FOUND = "doc_id long, item long, distance int, n_words int, start int, end int"


def _reporter(items: list, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, similarity)
        for batch in batches:
            ids, texts, rows = batch["doc_id"].to_pylist(), batch["text"].to_pylist(), []
            for doc_id, text, found in zip(ids, texts, matcher.matches(texts)):
                for n, (distance, first, end) in found.items():
                    item = matcher.items[n]
                    rows.append((doc_id, item.item_id, distance, len(item.words), *_spans(text, first, end)))
            types = [pa.int64(), pa.int64(), *([pa.int32()] * 4)]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)]
            yield pa.record_batch(columns, ["doc_id", "item", "distance", "n_words", "start", "end"])

    return run


def _sieve(items: list, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, similarity)
        for batch in batches:
            clean = [not found for found in matcher.matches(batch["_text"].to_pylist())]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def item_blocks(benchmark: DataFrame, size: int = BLOCK_ITEMS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of about `size` items, each small enough to send to every task."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text IS NOT NULL")
    n = max(1, -(-rows.count() // size))
    for block in range(n):
        yield [tuple(r) for r in rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, distance, n_words, start, end: items that documents hold, one row for a pair.

    A document holds an item if some run of its words is within (1 - `similarity`) of the item's
    words in word edits; distance, and start and end in characters, are of the best run found.
    Windows at every word of whole documents are embedded by CGK random walks and meet the items'
    windows in LSH tables; each meeting is verified by exact edit distance. Items of under
    `SHORT_WORDS` words, too short for the walks, are found without loss through their pieces; those
    of under five words may have no edit. Items without words are not searched. Null and empty texts hold nothing. Repeated rows give repeated
    results; a null doc_id is carried. Other columns are ignored; empty tables give none. The
    benchmark is a query set that is sent to the tasks in blocks; documents are not shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = None
    for items in item_blocks(benchmark):
        part = rows.mapInArrow(_reporter(items, similarity), FOUND)
        found = part if found is None else found.union(part)
    return found.withColumnRenamed("item", "item_id")


def decontaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `docs`, with all columns, whatever their names, that hold no item by the rule of `contaminated`.

    Null and empty texts stay, repeated rows share their fate, an empty table or benchmark drops nothing.
    """
    rows = carried(docs, _text=F.col("text").cast("string"))
    schema = rows.schema
    for items in item_blocks(benchmark):
        rows = rows.mapInArrow(_sieve(items, similarity), schema)
    return restored(rows, docs)
