"""SimHash near-duplicates: fingerprints of word shingles, found by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketwork.llm.common import carried, restored, stored
from basketwork.llm.components import components

SEED = 42
SEGMENT_BITS = 32
# Rows of one key that meet in a plain join, at most; keys with more are compared in blocks.
PLAIN_PAIRS = 256
BLOCK = 1024
# Full keys that are broadcast, at most: a few MB.
BROADCAST_KEYS = 100_000

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE_OFFSETS = (np.arange(8) * 256).astype(np.intp)


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text: a bit is set if over half the shingle hashes have it.

    A-Z are lower-cased, words are what ASCII white space separates, repeated shingles count
    repeatedly. Fewer words than a shingle make one shingle of all words; no words give 0.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    digest, join, size = xxhash.xxh64_intdigest, b" ".join, min(shingle, len(words))
    return print_of(np.array([digest(join(s), SEED) for s in zip(*(words[i:] for i in range(size)))], dtype="<u8"))


def print_of(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes, repeats included: a bit is set if over half of them have it; 0 of none."""
    total = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        seen = np.bincount((part + _BYTE_OFFSETS).ravel(), minlength=2048).reshape(8, 256)
        total += (seen @ _BITS).ravel()
    return int(sum(1 << int(b) for b in np.nonzero(2 * total > len(hashes))[0]))


def _fingerprints(shingle: int, more: tuple[str, ...] = ()):
    names = ["doc_id", *more, "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None, shingle) for t in batch["text"]]
            fps = pa.array(np.array(values, dtype="<u8").view("<i8"))
            yield pa.record_batch([*(batch[n] for n in names[:-1]), fps], names)

    return run


def with_fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row, whole texts."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _fingerprints(shingle), "doc_id long, fp long"
    )


def _segments(fps: DataFrame) -> DataFrame:
    """Table rows: each fingerprint under its low and its high half. The key's bit 32 tells the half."""
    low, high = F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", SEGMENT_BITS)
    return fps.select("fp", F.explode(F.array(low, high.bitwiseOR(1 << SEGMENT_BITS))).alias("key"))


def _probes(fps: DataFrame) -> DataFrame:
    """Probe rows: the ball of radius 1 around each half, as far as it sets bits.

    Of two halves that differ in one bit, one has the bit clear; setting it gives the other.
    So each close pair of halves meets once and half the ball is enough.
    """
    ball = F.array(F.lit(0).cast("long"), *(F.lit(1 << i).cast("long") for i in range(SEGMENT_BITS)))
    rows = _segments(fps).select("fp", "key", F.explode(ball).alias("flip"))
    return rows.filter("key & flip = 0").select("fp", F.expr("key | flip").alias("key"))


def _forest(left: np.ndarray, right: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between two blocks, fewer than their rows.

    A link is left out only if its ends are joined by other links of the result.
    """
    values = np.unique(np.concatenate([left, right]))
    label, at, edges = np.arange(len(values)), np.searchsorted(values, right), []
    for a in np.unique(left):
        i = int(np.searchsorted(values, a))
        close = at[np.bitwise_count(right ^ a) <= distance]
        labels, first = np.unique(label[close], return_index=True)
        for found, j in zip(labels, close[first]):
            if found != label[i]:
                edges.append((int(a), int(values[j])))
                label[label == found] = label[i]
    return edges


def _block_links(distance: int):
    def run(table: pa.Table) -> pa.Table:
        fps, table_side = table["fp"].to_numpy().view("<u8"), table["in_table"].to_numpy()
        edges = _forest(fps[~table_side], fps[table_side], distance)
        ends = np.array(edges, dtype="<u8").reshape(-1, 2).view("<i8")
        return pa.table({"node": ends[:, 0], "other": ends[:, 1]})

    return run


def links(fps: DataFrame, distance: int = 3, plain_pairs: int = PLAIN_PAIRS, block: int = BLOCK) -> DataFrame:
    """node, other: links that join exactly the fingerprints that links of `distance` bits join.

    `fps` has distinct fingerprints (fp). Two 32-bit halves, at most three bits apart in all,
    agree in one half up to one bit, so balls of radius 1 around the halves meet all pairs.
    A key with few rows joins plainly and its pairs are verified on all 64 bits. The rows of a
    fuller key are dealt into blocks; pairs of blocks are compared in many tasks, and each
    returns a spanning forest of its links, so output stays in proportion to the rows.
    Spark takes exploded rows for no more than the fingerprints they come from and would broadcast
    them, so the joins are named: by shuffle and sort, or with the counted full keys broadcast.
    """
    if distance > 3:
        raise ValueError("two halves with balls of radius 1 reach three differing bits")
    entries, probes = _segments(fps), _probes(fps)
    sides = entries.select("key", F.lit(1).alias("t"), F.lit(0).alias("p")).union(
        probes.select("key", F.lit(0).alias("t"), F.lit(1).alias("p"))
    )
    full = stored(
        sides.groupBy("key").agg(F.sum("t").alias("t"), F.sum("p").alias("p")).filter(f"t > 1 and t * p > {plain_pairs}"),
        "full-keys",
    )
    full = full.hint("broadcast" if full.count() <= BROADCAST_KEYS else "merge")
    plain = (
        probes.join(full.select("key"), "key", "left_anti")
        .select("key", F.col("fp").alias("node"))
        .join(entries.select("key", F.col("fp").alias("other")).hint("merge"), "key")
        .filter(f"node <> other and bit_count(node ^ other) <= {distance}")
        .select("node", "other")
    )
    sized = full.select(
        "key", F.ceil(F.col("t") / block).cast("int").alias("tb"), F.ceil(F.col("p") / block).cast("int").alias("pb")
    )
    share = lambda of: F.pmod(F.xxhash64("fp"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    hot_probes = probes.join(sized, "key").select("key", "fp", F.lit(False).alias("in_table"), share("pb").alias("i"), every("tb").alias("j"))
    hot_entries = entries.join(sized, "key").select("key", "fp", F.lit(True).alias("in_table"), every("pb").alias("i"), share("tb").alias("j"))
    blocks = hot_probes.union(hot_entries).groupBy("key", "i", "j").applyInArrow(_block_links(distance), "node long, other long")
    return plain.union(blocks)


def _components(prints: DataFrame, distance: int) -> DataFrame:
    """fp, component (a fingerprint) of every distinct fingerprint."""
    nodes = stored(prints.select("fp").distinct(), "distinct-fingerprints")
    linked = components(links(nodes, distance)).withColumnRenamed("node", "fp")
    return nodes.join(linked, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable) of every row.

    Documents link if their fingerprints differ in at most `distance` bits; exact copies share a
    fingerprint and are one node of the search. Null and blank texts have fingerprint 0 and are
    linked like others. Rows are kept as they are: a repeated row gives a repeated result, a row
    with null doc_id joins a component but does not name it (null only if no member has an id).
    Columns other than doc_id and text are ignored; an empty table gives an empty result.
    """
    prints = stored(with_fingerprints(docs, shingle), "fingerprints")
    ids = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = stored(_components(prints, distance).join(ids, "fp"), "components")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = named.join(least, "component").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def without_near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """`docs` with one row of each group of near-duplicates: of least doc_id, then of least text hash.

    Groups are those of `near_duplicates`; a row with null doc_id stays only if its group has no
    id. Of rows that are equal in doc_id and text one stays. All columns are kept.
    """
    prints = stored(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("digest"))
        .mapInArrow(_fingerprints(shingle, ("digest",)), "doc_id long, digest long, fp long"),
        "fingerprints",
    )
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    first = prints.groupBy("fp").agg(F.min(row).alias("row"))
    best = first.join(_components(prints, distance), "fp").groupBy("component").agg(F.min("row").alias("row"))
    keep = best.select(F.col("row.doc_id").alias("_id"), F.col("row.digest").alias("_digest"))
    own = carried(docs, _doc=F.col("doc_id").cast("long"), _own=F.xxhash64("text"))
    chosen = own.join(keep, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest")), "left_semi")
    return restored(chosen.dropDuplicates(["_doc", "_own"]), docs)
