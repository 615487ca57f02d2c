"""Alignment of two tokenizers' tokens on the bytes of each text, by as-of joins keyed by document.

A is a byte-level BPE file of `tokenizers`, which reads a blank and the text; B is a `sentencepiece` model, which
adds that blank itself. Both cover the same bytes, so the token of the other side that covers a token's start is
the last one to start there or before: one `merge_asof` each way gives all overlaps, and ends that both sides
share cut the tokens into groups.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketwork.llm.common import stored
from basketwork.llm.token_counts import tokenizer_file

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SLICE_BYTES = 1_500_000
MEMO_CHUNKS = 300_000
BLANK = "▁"
# A blank between letters, digits or ASCII marks: neither tokenizer has tokens across its left side.
CUT = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")
OTHER_BLANK = r"(?:\A|[^\pL\pN!-~]) | (?:[^\pL\pN!-~]|\z)"
JOINABLE = re.compile(r"[\w!-~](?:.*[\w!-~])?", re.S)
JOINED = 200
OVERLAPS = "overlaps array<struct<a: int, b: int>>"
SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_overlaps long, n_links long, groups string, "
    "pairs array<long>, pair_links array<int>, slice_pairs array<long>, slice_links array<long>"
)


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, the bytes of their entries, and a memory of chunks between blanks."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        alphabet, entries = byte_alphabet(), self.a.get_vocab()
        a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            known = all(c in alphabet for c in entry)
            a_bytes[i] = bytes(map(alphabet.__getitem__, entry)) if known else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(BLANK in piece.lstrip(BLANK) for piece in pieces):
            raise ValueError("a piece of B has a blank after another character")
        b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.bytes = [pa.array(a_bytes, pa.binary()), pa.array(b_bytes, pa.binary())]
        self.sizes = [np.array([len(x) for x in side], np.int64) for side in (a_bytes, b_bytes)]
        self.n_b = len(b_bytes)
        # decimal ids behind each separator; rows of this table in a row are a text of groups
        ids = range(max(len(a_bytes), len(b_bytes)))
        self.decimals = pa.array([mark + str(i) for mark in ("", ",", ";", "|") for i in ids], pa.string())
        self.n_decimals = len(ids)
        self.memo: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})

    def _remember(self, new: list[str]) -> None:
        """Ids of new chunks. A reads many in one text, cut where their bytes end, since each call costs."""
        joinable = [c for c in new if JOINABLE.fullmatch(c)]
        apart = [c for c in new if not JOINABLE.fullmatch(c)]
        parts = [joinable[i : i + JOINED] for i in range(0, len(joinable), JOINED)]
        for part, e in zip(parts, self.a.encode_batch_fast([" " + " ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(e.ids, np.int32)
            ends = np.cumsum([len(c.encode()) + 1 for c in part])
            cuts = np.searchsorted(np.cumsum(self.sizes[0][ids]), ends) + 1
            data, last = ids.tobytes(), 0
            for c, cut in zip(part, (4 * cuts).tolist()):
                self.memo[0][c] = data[last:cut]
                last = cut
        for c, e in zip(apart, self.a.encode_batch_fast([" " + c for c in apart], add_special_tokens=False)):
            self.memo[0][c] = np.array(e.ids, np.int32).tobytes()
        for c, ids in zip(new, self.b.encode(new, num_threads=1)):
            self.memo[1][c] = array("i", ids).tobytes()

    def encoded(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B: the ids of all texts in a row, and how many each text has."""
        column = pa.array(texts, pa.string())
        if pc.any(odd := pc.match_substring_regex(column, OTHER_BLANK)).as_py():
            chunks = [CUT.split(t) if o else t.split(" ") for t, o in zip(texts, odd.to_pylist())]
            split = pa.array(chunks, pa.list_(pa.string()))
        else:
            split = pc.split_pattern(column, " ")
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.memo[0]) > MEMO_CHUNKS:
            self.memo[0].clear()
            self.memo[1].clear()
        if new := [c for c in distinct if c not in self.memo[0]]:
            self._remember(new)
        word, first = coded.indices.to_numpy(), split.offsets.to_numpy()[:-1]
        out = []
        for memo in self.memo:
            found = list(map(memo.__getitem__, distinct))
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            ids, begin = np.frombuffer(b"".join(found), np.int32), np.cumsum(sizes) - sizes
            times = sizes[word]
            end = np.cumsum(times)
            place = np.arange(end[-1]) + np.repeat(begin[word] - end + times, times)
            out.append((ids[place], np.add.reduceat(times, first)))
        return out


@lru_cache(maxsize=1)
def _tokenizers(a_file: str, b_file: str) -> Tokenizers:
    """One for each Python worker, which runs many tasks."""
    return Tokenizers(a_file, b_file)


def _same_bytes(t: Tokenizers, side: int, ids: np.ndarray, counts: np.ndarray, wanted: list[bytes]) -> np.ndarray:
    """Whether each text's tokens join to its wanted bytes."""
    joined = t.bytes[side].take(pa.array(ids))
    data = joined.buffers()[2].to_pybytes()
    ends = np.cumsum(np.concatenate([[0], t.sizes[side][ids]]))[np.cumsum(np.concatenate([[0], counts]))]
    return np.array([data[s:e] == w for s, e, w in zip(ends[:-1].tolist(), ends[1:].tolist(), wanted)], bool)


def _side(t: Tokenizers, side: int, ids: np.ndarray, owner: np.ndarray) -> pd.DataFrame:
    end = np.cumsum(t.sizes[side][ids])
    return pd.DataFrame({"start": end - t.sizes[side][ids], "end": end, "doc": owner, "at": np.arange(len(ids))})


def overlapping(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Pairs of row numbers of tokens that share bytes: `a`, `b`, and whether they end together.

    Both frames hold start, end, doc and at (the row number), by start; the tokens of a document
    cover the same bytes on both sides.
    """
    there = pd.merge_asof(a, b, on="start", by="doc", suffixes=("_a", "_b"))
    back = pd.merge_asof(b, a.assign(begin=a["start"]), on="start", by="doc", suffixes=("_b", "_a"))
    back = back[back["begin"] < back["start"]]  # equal starts are in the other direction already
    both = pd.concat([there, back])
    return pd.DataFrame({"a": both["at_a"], "b": both["at_b"], "ends": both["end_a"] == both["end_b"]})


def _group_texts(t: Tokenizers, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, n_a, n_b) -> pa.Array:
    """`a1,a2|b1;a3|b2,b3` of every document: ids of A and B by group, written by one take from a table."""
    sides, order = [], []
    group = [np.cumsum(last) - last for last in (last_a, last_b)]
    sizes = [np.bincount(g, minlength=int(last_a.sum())) for g in group]
    before = [np.cumsum(s) - s for s in sizes]
    for ids, last, g, other, mark in ((a, last_a, group[0], before[1], 2), (b, last_b, group[1], before[0] + sizes[0], 3)):
        begins = np.concatenate([[True], last[:-1]]) if len(last) else last
        sides.append(ids + t.n_decimals * np.where(begins, mark, 1))
        order.append(np.arange(len(ids)) + other[g])
    starts = np.cumsum(n_a) - n_a
    sides[0][starts] -= 2 * t.n_decimals  # no separator before a document's first id
    places = np.empty(len(a) + len(b), np.int64)
    places[order[0]], places[order[1]] = sides
    written = t.decimals.take(pa.array(places))
    offsets = np.frombuffer(written.buffers()[1], np.int32)[np.cumsum(np.concatenate([[0], n_a + n_b]))]
    return pa.StringArray.from_buffers(len(n_a), pa.py_buffer(offsets), written.buffers()[2])


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate([[0], counts])), pa.int32()), pa.array(values, kind))


def _aligned(t: Tokenizers, ids: list, texts: list[str | None], with_overlaps: bool) -> pa.RecordBatch:
    n, full = len(ids), [k for k, text in enumerate(texts) if text]
    wanted = [b" " + texts[k].encode() for k in full]
    sides, same = t.encoded([texts[k] for k in full]) if full else [], np.ones(len(full), bool)
    for side, (tokens, counts) in enumerate(sides):
        same &= _same_bytes(t, side, tokens, counts, wanted)
    kept = np.array(full, np.int64)[same]  # rows with tokens, in order
    frames, tokens, counts = [], [], []
    for side, (every, number) in enumerate(sides):
        tokens.append(every[np.repeat(same, number)])
        counts.append(number[same])
        frames.append(_side(t, side, tokens[-1], np.repeat(np.arange(len(kept)), counts[-1])))
    out = {name: np.zeros(n, np.int64) for name in ("n_a", "n_b", "n_groups", "n_overlaps", "n_links")}
    groups, flat, n_pairs = [""] * n, (np.empty(0, np.int64),) * 2, np.zeros(n, np.int64)
    shared, of_slice = pd.DataFrame({"a": [], "b": [], "doc": []}, dtype=np.int64), (np.empty(0, np.int64),) * 2
    if len(kept):
        shared = overlapping(*frames)
        shared["doc"] = frames[0]["doc"].to_numpy()[shared["a"]]
        links = shared[shared["ends"]]
        last = [np.zeros(len(x), bool) for x in tokens]
        last[0][links["a"]], last[1][links["b"]] = True, True
        per_doc = lambda rows: np.bincount(rows["doc"], minlength=len(kept))
        figures = (*counts, np.bincount(frames[0]["doc"][last[0]], minlength=len(kept)), per_doc(shared), per_doc(links))
        for name, values in zip(out, figures):
            out[name][kept] = values
        texts_of = _group_texts(t, *tokens, *last, *counts)
        pair = tokens[0][links["a"]].astype(np.int64) * t.n_b + tokens[1][links["b"]]
        span = len(t.sizes[0]) * t.n_b
        distinct, times = np.unique(links["doc"].to_numpy() * span + pair, return_counts=True)
        flat = distinct % span, times
        n_pairs[kept] = np.bincount(distinct // span, minlength=len(kept))
        of_slice = np.unique(pair, return_counts=True)
        if len(kept) == n:
            groups = texts_of
        else:
            place = np.full(n, -1)
            place[kept] = np.arange(len(kept))
            groups = texts_of.take(pa.array(place, mask=place < 0)).fill_null("")
    columns = [pa.array(ids, pa.int64()), *map(pa.array, out.values()), pa.array(groups, pa.string()) if isinstance(groups, list) else groups]
    columns += [_lists(flat[0], n_pairs, pa.int64()), _lists(flat[1], n_pairs, pa.int32())]
    columns += [_lists(x, np.r_[len(x), np.zeros(n - 1, np.int64)], pa.int64()) for x in of_slice]
    names = ["doc_id", *out, "groups", "pairs", "pair_links", "slice_pairs", "slice_links"]
    if with_overlaps:
        first = [np.cumsum(c) - c for c in counts] or [np.empty(0, np.int64)] * 2
        shared = shared.sort_values(["a", "b"])
        parts = [pa.array(shared[s].to_numpy() - f[shared["doc"]], pa.int32()) for s, f in zip("ab", first)]
        listed = pa.array(np.cumsum(np.r_[0, out["n_overlaps"]]), pa.int32())
        columns.append(pa.ListArray.from_arrays(listed, pa.StructArray.from_arrays(parts, ["a", "b"])))
        names.append("overlaps")
    return pa.record_batch(columns, names)


def _aligner(a_file: str, b_file: str, with_overlaps: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizers(a_file, b_file)
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids.append(doc_id)
                texts.append(text.as_py())
                size += 100 + len(texts[-1] or "")
                if size >= SLICE_BYTES:
                    yield _aligned(t, ids, texts, with_overlaps)
                    ids, texts, size = [], [], 0
            if ids:
                yield _aligned(t, ids, texts, with_overlaps)

    return run


def alignments(docs: DataFrame, a_file: str | None = None, b_file: str | None = None, with_overlaps: bool = False) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_overlaps, n_links, groups, and the linked id pairs with their number.

    A link is an overlap of two tokens that end together. `groups` is `a1,a2|b1;a3|b2,b3`: ids of A and of B
    up to each shared end. `pairs` holds A id * size of B's vocabulary + B id, `pair_links` the links of each;
    `slice_pairs` and `slice_links` sum them over the rows read together and stand in the first of these. With
    `with_overlaps`, `overlaps` lists the positions of overlapping tokens in the text's A and B tokens.

    Null and empty texts, and texts that either tokenizer does not give back byte for byte, have no tokens: zeros,
    empty lists and an empty `groups`. Rows are kept as they are, repeated and null ids included; an empty table
    gives none; other columns are ignored, whatever their names. Nothing is shuffled. Chunks between blanks are
    remembered per worker, since neither tokenizer has tokens across a word's leading blank; a model B with a
    piece that has a blank after another character is refused.
    """
    a_file, b_file = a_file or tokenizer_file(A_FILE), b_file or tokenizer_file(B_FILE)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_aligner(a_file, b_file, with_overlaps), SCHEMA + (f", {OVERLAPS}" if with_overlaps else ""))


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """pair, b, links over the whole corpus, and whether that is the highest number of the pair's B id.

    Linked ids end in the same bytes, so one entry ends the other: the two vocabularies bound the rows,
    whatever the corpus (`most_pairs`).
    """
    sums = aligned.filter(F.size("slice_pairs") > 0).select(F.explode(F.arrays_zip("slice_pairs", "slice_links")).alias("x"))
    counted = sums.groupBy(F.col("x.slice_pairs").alias("pair")).agg(F.sum("x.slice_links").alias("links"))
    counted = counted.withColumn("b", F.col("pair") % n_b)
    best = counted.groupBy("b").agg(F.max("links").alias("most"))
    return counted.join(best, "b").select("pair", "b", "links", (F.col("links") == F.col("most")).alias("best"))


def most_pairs(t: Tokenizers) -> int:
    """How many pairs of entries can end together: one is the end of the other."""
    sides = [[x for x in side.to_pylist() if x] for side in t.bytes]
    ends = [pd.Series(side).value_counts().to_dict() for side in sides]
    total = 0
    for own, other, start in ((sides[0], ends[1], 0), (sides[1], ends[0], 1)):
        total += sum(other.get(x[i:], 0) for x in own for i in range(start, len(x)))
    return total


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, links, best = shared.value
        for batch in batches:
            listed, times = batch["pairs"], batch["pair_links"].flatten().to_numpy(zero_copy_only=False)
            at = np.searchsorted(pairs, listed.flatten().to_numpy(zero_copy_only=False))
            cuts = listed.offsets.to_numpy() - listed.offsets[0].as_py()
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[at], times * links[at])]
            columns = [batch[n] for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            columns += [pa.array(s[cuts[1:]] - s[cuts[:-1]], pa.int64()) for s in sums]
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
            yield pa.record_batch(columns, names)

    return run


def link_report(docs: DataFrame, a_file: str | None = None, b_file: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    An id pair counts its links in the whole corpus. `count_sum` sums that count over a document's links; `n_best`
    is how many of its links have the highest count of their B id, ties included. `groups_sha256` hashes `groups`,
    and is empty without tokens. Rows, nulls and refused texts are as in `alignments`. Texts are encoded once; the
    counts, which the vocabularies bound, reach the tasks as a broadcast.
    """
    files = a_file or tokenizer_file(A_FILE), b_file or tokenizer_file(B_FILE)
    hashed = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "pairs", "pair_links", "slice_pairs", "slice_links"]
    aligned = stored(alignments(docs, *files).select(*kept, hashed), "aligned")
    counted = pair_counts(aligned, _tokenizers(*files).n_b).select("pair", "links", "best").toArrow().sort_by("pair")
    table = tuple(counted[c].to_numpy() for c in ("pair", "links", "best"))
    shared = docs.sparkSession.sparkContext.broadcast(table)
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    rows = aligned.drop("slice_pairs", "slice_links").mapInArrow(_scorer(shared), schema)
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
