"""Runs of repeated words: string synchronising sets at dyadic scales propose periods.

A run is a maximal stretch of words with smallest period q and at least 2q words. How each is found:

* q below 3 * FIRST_SCALE: words q apart are compared directly.
* q from 3t up to 6t for every scale t = FIRST_SCALE, twice that, and so on: a hash of the t words from each
  position, minimal in its neighbourhood, selects the scale's synchronising set. Whether a position belongs to it
  depends on the 2t words from there alone, so the set repeats with the run, and two of its positions with equal 2t
  words, 3t to 6t apart, propose the period. Positions whose t words have a period of t/3 or less are never
  minimal, so equal contexts are at least t/3 apart and a position has under 20 partners: no cap is needed.
* A run without a selected position in its first period begins with a whole period of words whose own period is p,
  at most t/3. Its first two periods then lie in two runs of period p that touch or overlap by fewer than p words.
  Those runs are known from smaller scales, and supply all periods that bring them into phase.

Proposed periods are extended both ways by hashes and then checked word by word, so a collision cannot reach the
result: a document with one is done again by comparing every distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIRST_SCALE = 8
MIN_LENGTH = 12
CHUNK_WORDS = 150_000
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
NONE = np.empty((0, 3), np.int64)  # start, end, period
_BASE = 0x9E3779B97F4A7C15 | 1
_LARGEST = np.uint64(2**64 - 1)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""

    def powers(base: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return powers(_BASE), powers(pow(_BASE, -1, 2**64))


class Windows:
    """Hashes of any window of a sequence from prefix sums: equal words give equal hashes."""

    def __init__(self, words: np.ndarray):
        up, self.down = _powers(1 << (len(words) + 1).bit_length())
        mixed = words.astype(np.uint64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            mixed = (mixed + np.uint64(_BASE)) ^ (mixed >> np.uint64(shift))
            mixed *= np.uint64(factor)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mixed * up[: len(words)], out=self.sums[1:])

    def at(self, start: np.ndarray, size: int) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.down[start]

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.down[:n]


def _stretches(words: np.ndarray, period: int, least: int) -> np.ndarray:
    """Maximal stretches of at least `least` words that equal the word `period` before."""
    same = np.flatnonzero(words[period:] == words[:-period])
    need = least - period
    if len(same) < need or not (same[need - 1 :] - same[: len(same) - need + 1] == need - 1).any():
        return NONE
    cuts = np.flatnonzero(np.diff(same) != 1) + 1
    first, last = same[np.r_[0, cuts]], same[np.r_[cuts - 1, len(same) - 1]]
    found = np.column_stack([first, last + 1 + period, np.full(len(first), period)])
    return found[found[:, 1] - found[:, 0] >= least]


def _smallest_periods(runs: np.ndarray) -> np.ndarray:
    """One row per stretch, with its smallest period; by start, then end."""
    runs = runs[np.lexsort(runs.T[[2, 1, 0]])]
    new = np.ones(len(runs), bool)
    new[1:] = (np.diff(runs[:, :2], axis=0) != 0).any(axis=1)
    return runs[new]


def synchronising_set(hashes: Windows, scale: int, runs: np.ndarray) -> np.ndarray:
    """Positions whose `scale` words, or those `scale` later, have the least hash of all between."""
    values = hashes.all(scale)
    if len(values) <= scale:
        return np.empty(0, np.int64)
    for start, end, _ in runs[(runs[:, 2] * 3 <= scale) & (runs[:, 1] - runs[:, 0] >= scale)]:
        values[start : end - scale + 1] = _LARGEST
    least, width = values, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], least[1:])
    n = len(least)
    chosen = (least == values[:n]) | (least == values[scale : scale + n])
    return np.flatnonzero(chosen & (least != _LARGEST))


def _equal_contexts(hashes: Windows, scale: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of chosen positions with equal 2 * scale words, 3 to under 6 scales apart."""
    context = hashes.at(chosen, 2 * scale)
    order = np.argsort(context, kind="stable")
    context, place = context[order], chosen[order]
    left, right, step = [], [], 1
    while step < len(place):
        apart = place[step:] - place[:-step]
        near = (context[step:] == context[:-step]) & (apart < 6 * scale)
        if not near.any():
            break
        near &= apart >= 3 * scale
        left.append(place[:-step][near])
        right.append(place[step:][near])
        step += 1
    none = [np.empty(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def _from_periodic_regions(hashes: Windows, scale: int, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs 3 to under 6 scales apart that bring two meeting runs of one small period into phase."""
    long = runs[(runs[:, 2] * 3 <= scale) & (runs[:, 1] - runs[:, 0] >= 3 * scale)]
    long = long[np.lexsort((long[:, 0], long[:, 2]))]
    meet = np.flatnonzero((long[:-1, 2] == long[1:, 2]) & (long[1:, 0] <= long[:-1, 1]))
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k in meet:
        (s1, e1, p), (s2, e2, _) = long[k].tolist(), long[k + 1].tolist()
        phase = np.flatnonzero(hashes.at(np.arange(s1, s1 + p), p) == hashes.at(np.array([s2]), p))
        if len(phase):
            first = 3 * scale + (s2 - s1 - int(phase[0]) - 3 * scale) % p
            periods = np.arange(first, min(6 * scale - 1, e1 - s1, e2 - s2) + 1, p)
            start = np.maximum(s1, s2 - periods)
            left.append(start)
            right.append(start + periods)
    return np.concatenate(left), np.concatenate(right)


def _extended(hashes: Windows, longest: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The runs around pairs of positions, if of two periods or more."""
    n, powers = len(hashes.sums) - 1, [1 << k for k in range(longest.bit_length(), -1, -1)]
    after, before = np.zeros_like(left), np.zeros_like(left)
    for size in powers:
        fits = np.flatnonzero(right + after + size <= n)
        a, b = left[fits] + after[fits], right[fits] + after[fits]
        after[fits[hashes.at(a, size) == hashes.at(b, size)]] += size
        fits = np.flatnonzero(left - before >= size)
        a, b = left[fits] - before[fits] - size, right[fits] - before[fits] - size
        before[fits[hashes.at(a, size) == hashes.at(b, size)]] += size
    found = np.column_stack([left - before, right + after, right - left])
    return np.unique(found[found[:, 1] - found[:, 0] >= 2 * found[:, 2]], axis=0)


def _is_run(words: np.ndarray, start: int, end: int, period: int) -> bool:
    return (
        np.array_equal(words[start : end - period], words[start + period : end])
        and (start == 0 or words[start - 1] != words[start + period - 1])
        and (end == len(words) or words[end] != words[end - period])
    )


def runs_of(words: np.ndarray, longest: int) -> np.ndarray:
    """start, end, period of every run of at least max(MIN_LENGTH, 2 * period) words, by start.

    `words` holds word numbers; several texts of at most `longest` words may be joined by numbers
    that occur once. Exact but for hash collisions, which show in the final check (ValueError).
    """
    found = [NONE]
    for period in range(1, min(3 * FIRST_SCALE, longest // 2 + 1)):
        least = FIRST_SCALE if period * 3 <= FIRST_SCALE else MIN_LENGTH
        found.append(_stretches(words, period, max(least, 2 * period)))
    runs, scale, hashes = _smallest_periods(np.concatenate(found)), FIRST_SCALE, None
    while 6 * scale <= longest:
        hashes = hashes or Windows(words)
        pairs = _equal_contexts(hashes, scale, synchronising_set(hashes, scale, runs))
        more = _from_periodic_regions(hashes, scale, runs)
        left, right = (np.concatenate(side) for side in zip(pairs, more))
        if len(left):
            runs = _smallest_periods(np.concatenate([runs, _extended(hashes, longest, left, right)]))
        scale *= 2
    runs = runs[runs[:, 1] - runs[:, 0] >= MIN_LENGTH]
    if not all(_is_run(words, *run) for run in runs.tolist()):
        raise ValueError("hash collision")
    return runs


def runs_by_every_distance(words: np.ndarray) -> np.ndarray:
    """The same for one text, by comparing words at every distance: quadratic."""
    found = [_stretches(words, p, max(MIN_LENGTH, 2 * p)) for p in range(1, len(words) // 2 + 1)]
    return _smallest_periods(np.concatenate([NONE, *found]))


def _of_each(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Runs of each text; texts of like length are searched as one sequence."""
    out, classes = [NONE] * len(texts), {}
    for k, words in enumerate(texts):
        if len(words) >= MIN_LENGTH:
            classes.setdefault(len(words).bit_length(), []).append(k)
    for members in classes.values():
        lengths = np.array([len(texts[k]) + 1 for k in members])
        ends = np.cumsum(lengths)
        joined = np.concatenate([part for k, mark in zip(members, ends) for part in (texts[k], [-mark])])
        try:
            runs = runs_of(joined, int(lengths.max()) - 1)
        except ValueError:
            for k in members:
                out[k] = runs_by_every_distance(texts[k])
            continue
        owner = np.searchsorted(ends, runs[:, 0], side="right")
        begin = ends - lengths
        cuts = np.searchsorted(owner, np.arange(len(members) + 1))
        for at, k in enumerate(members):
            if cuts[at] < cuts[at + 1]:
                out[k] = runs[cuts[at] : cuts[at + 1]] - [begin[at], begin[at], 0]
    return out


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """Words but for those that a run repeats: what follows its first period."""
    if len(runs):
        kept = np.ones(len(words), bool)
        for start, end, period in runs.tolist():
            kept[start + period : end] = False
        words = compress(words, kept.tolist())
    return b" ".join(words)


def _rows(ids: list, split: list[list[bytes]]) -> pa.RecordBatch:
    every = [w for words in split for w in words]
    number = {w: i for i, w in enumerate(set(every))}
    numbered = np.fromiter(map(number.__getitem__, every), np.int32, len(every))
    runs = _of_each(np.split(numbered, np.cumsum([len(words) for words in split])[:-1]))
    flat = np.concatenate([NONE, *runs])
    parts = [pa.array(flat[:, 0]), pa.array(flat[:, 1] - flat[:, 0]), pa.array(flat[:, 2])]
    offsets = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
    listed = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
    collapsed = pa.array([_collapsed(w, r) for w, r in zip(split, runs)], pa.binary()).view(pa.string())
    columns = [pa.array(ids, pa.int64()), pa.array([len(w) for w in split], pa.int64()), listed, collapsed]
    return pa.record_batch(columns, ["doc_id", "n_words", "runs", "collapsed"])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, split, size = [], [], 0
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            # bytes.split() cuts at ASCII white space, the complement of the word rule
            words = text.as_buffer().to_pybytes().split() if text.is_valid else []
            ids.append(doc_id)
            split.append(words)
            size += len(words)
            if size >= CHUNK_WORDS:
                yield _rows(ids, split)
                ids, split, size = [], [], 0
        if ids:
            yield _rows(ids, split)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period in words, by start) and the text with each run collapsed.

    A run has at least max(12, twice its smallest period) words, and no neighbouring word extends it.
    `collapsed` joins by one blank the words that no run holds after its first period. Null and blank texts have no
    words, no runs and an empty collapsed text. Every row gives one row, in tasks of their own without a shuffle,
    repeated rows and null ids included; an empty table gives none; other columns are ignored, whatever their names.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_search, SCHEMA)
