"""Near copies by exact similarity of word shingles, on candidates that SimHash fingerprints and MinHash bands bring together."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketwork.llm import simhash
from basketwork.llm.common import carried, restored, stored
from basketwork.llm.components import components

SHINGLE, SIMILARITY = 5, 0.8
SEED = 42
# At similarity 0.8 a pair shares no band with probability (1 - 0.8 ** ROWS) ** BANDS = 0.0002.
BANDS, ROWS = 16, 4
# Least share of equal minima for an exact comparison; six deviations below SIMILARITY.
LEAST_ESTIMATE = 0.5
# Rows and bytes of one block of a candidate group; larger groups are compared in pairs of blocks.
BLOCK_ROWS, BLOCK_BYTES = 1024, 8 << 20
CHUNK = 2048

_random = np.random.default_rng(SEED)
_FACTORS = _random.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_ADDED = _random.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)


def digests(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the word shingles in order, repeats included; words and short texts as in `simhash.fingerprint`."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, dtype="<u8")
    digest, join, size = xxhash.xxh64_intdigest, b" ".join, min(shingle, len(words))
    return np.array([digest(join(s), SEED) for s in zip(*(words[i:] for i in range(size)))], dtype="<u8")


def shingles(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles."""
    return np.unique(digests(text, shingle))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The MinHash signature of shingle hashes: the upper half of the least value of each permutation."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start : start + CHUNK, None] * _FACTORS + _ADDED
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def _band_keys(signature: np.ndarray) -> list[int]:
    return [xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(signature.reshape(BANDS, ROWS))]


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, dtype="<u8").view("<i8"))


def _text(value: pa.Scalar) -> bytes | None:
    return value.as_buffer().to_pybytes() if value.is_valid else None


SKETCH = "doc_id long, digest long, node long, bands array<long>, minima binary"


def _sketches(batches: Iterator[pa.RecordBatch], prints: bool = False) -> Iterator[pa.RecordBatch]:
    """`SKETCH` of each row; with `prints` also fp, the SimHash fingerprint of the same shingles."""
    for batch in batches:
        nodes, bands, least, fps = [], [], [], []
        for text in batch["text"]:
            every = digests(_text(text))
            hashes = np.unique(every)
            signature = minima(hashes)
            nodes.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
            bands += _band_keys(signature)
            least.append(signature.tobytes())
            if prints:
                fps.append(simhash.print_of(every))
        offsets = pa.array(np.arange(len(nodes) + 1, dtype=np.int32) * BANDS)
        keys = pa.ListArray.from_arrays(offsets, _signed(bands))
        columns = [batch["doc_id"], batch["digest"], _signed(nodes), keys, pa.array(least, pa.binary())]
        names = ["doc_id", "digest", "node", "bands", "minima"]
        yield pa.record_batch([*columns, _signed(fps)] if prints else columns, [*names, "fp"] if prints else names)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(_text(t)) for t in batch["text"]]
        columns = [batch["node"], batch["component"], pa.array([h.tobytes() for h in found], pa.binary()), pa.array([minima(h).tobytes() for h in found], pa.binary())]
        yield pa.record_batch(columns, ["node", "component", "hashes", "minima"])


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets of hashes have at least this Jaccard similarity."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(large) or len(small) < similarity * len(large) - 1e-9:
        return not len(large)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int(np.count_nonzero(large[at] == small))
    return common >= similarity * (len(a) + len(b) - common) - 1e-9


def _spanning(nodes: np.ndarray, shares: np.ndarray, near) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs that are near; with two shares, of pairs across them.

    `near(i, others)` gives those of the places `others` that are near place i. Each place asks once, and only for
    places that nothing has reached yet: a group of near copies is reached from its first member.
    """
    edges, across, unseen = [], len(np.unique(shares)) > 1, np.ones(len(nodes), bool)
    for start in range(len(nodes)):
        queue = [start] if unseen[start] else []
        unseen[start] = False
        while queue:
            i = queue.pop()
            others = np.flatnonzero(unseen & (shares != shares[i]) if across else unseen)
            if len(others):
                found = near(i, others)
                unseen[found] = False
                edges += [(int(nodes[i]), int(nodes[j])) for j in found]
                queue += found.tolist()
    return edges


def forest(nodes: np.ndarray, shares: np.ndarray, sets: list[np.ndarray], signatures: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs that are alike; with two shares, of pairs across them.

    Pairs whose sizes or signatures are too far apart are not compared.
    """
    sizes = np.array([len(s) for s in sets])

    def near(i: int, others: np.ndarray) -> np.ndarray:
        low, high = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[low >= similarity * high - 1e-9]
        others = others[(signatures[others] == signatures[i]).mean(axis=1) >= LEAST_ESTIMATE]
        return np.array([j for j in others if alike(sets[j], sets[i], similarity)], dtype=np.int64)

    return _spanning(nodes, shares, near)


def _block_links(similarity: float):
    def run(table: pa.Table) -> pa.Table:
        nodes, shares = table["node"].to_numpy(), table["share"].to_numpy()
        sets = [np.frombuffer(h.as_buffer(), dtype="<u8") for h in table["hashes"]]
        signatures = np.stack([np.frombuffer(m.as_buffer(), dtype="<u4") for m in table["minima"]])
        ends = np.array(forest(nodes, shares, sets, signatures, similarity), dtype=np.int64).reshape(-1, 2)
        return pa.table({"node": ends[:, 0], "other": ends[:, 1]})

    return run


def estimated(nodes: np.ndarray, shares: np.ndarray, signatures: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs whose signatures agree in `LEAST_ESTIMATE` of their minima; with two shares, across them."""
    return _spanning(nodes, shares, lambda i, others: others[(signatures[others] == signatures[i]).mean(axis=1) >= LEAST_ESTIMATE])


def _band_links(table: pa.Table) -> pa.Table:
    signatures = np.stack([np.frombuffer(m.as_buffer(), dtype="<u4") for m in table["minima"]])
    ends = np.array(estimated(table["node"].to_numpy(), table["share"].to_numpy(), signatures), dtype=np.int64).reshape(-1, 2)
    return pa.table({"node": ends[:, 0], "other": ends[:, 1]})


def _print_links(sketches: DataFrame) -> DataFrame:
    """node, other: links that join the nodes whose fingerprints `simhash.links` joins, or that share a fingerprint."""
    prints = stored(sketches.select("fp", "node").distinct(), "prints")
    heads = stored(prints.groupBy("fp").agg(F.min("node").alias("head")), "print-heads")
    same = prints.join(heads, "fp").select("node", F.col("head").alias("other"))
    ends = [heads.select(F.col("fp").alias(end), F.col("head").alias(f"{end}_head")) for end in ("node", "other")]
    across = simhash.links(heads.select("fp")).join(ends[0], "node").join(ends[1], "other")
    return same.union(across.select(F.col("node_head").alias("node"), F.col("other_head").alias("other")))


def _candidate_groups(sketches: DataFrame, close: DataFrame | None = None) -> DataFrame:
    """node, component: nodes joined, directly or over others, by links of `close` or by a common band and signatures that agree.

    A band alone joins nothing: texts that share one by chance or by common passages stay apart unless half of their
    minima agree. Signatures, not sets, meet by band; a band of many nodes is compared in pairs of blocks, each of
    which returns a forest.
    """
    keyed = stored(sketches.select("node", F.explode("bands").alias("key")).distinct(), "bands")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = keyed.join(sizes.select("key", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("m")).hint("merge"), "key")
    signed = members.join(sketches.select("node", "minima").dropDuplicates(["node"]), "node")
    found = signed.transform(_block_pairs, "key").groupBy("key", "i", "j").applyInArrow(_band_links, "node long, other long")
    linked = components(found if close is None else found.union(close))
    return linked.union(linked.select(F.col("component").alias("node"), "component")).distinct()


def _block_pairs(rows: DataFrame, group: str) -> DataFrame:
    """Rows of groups of `m` blocks, each dealt to its block and repeated for every pair i, j of blocks it belongs to."""
    dealt = rows.withColumn("share", F.pmod(F.xxhash64("node"), "m").cast("int"))
    paired = dealt.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    rest = [c for c in rows.columns if c not in (group, "m")]
    return paired.select(group, F.least("share", "k").alias("i"), F.greatest("share", "k").alias("j"), *rest, "share")


def links(sets: DataFrame, similarity: float = SIMILARITY, rows: int = BLOCK_ROWS, size: int = BLOCK_BYTES) -> DataFrame:
    """node, other: links that join, in each candidate group (component), what pairs of at least `similarity` join.

    A group over a block's rows or bytes is dealt into blocks, and each pair of blocks is
    compared in a task of its own, which returns a forest: never more edges than rows.
    """
    sized = sets.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("hashes") + F.length("minima")).alias("b"))
    sized = sized.select("component", F.greatest(F.ceil(F.col("n") / rows), F.ceil(F.col("b") / size)).cast("int").alias("m"))
    paired = sets.join(stored(sized, "group-sizes"), "component").transform(_block_pairs, "component")
    return paired.groupBy("component", "i", "j").applyInArrow(_block_links(similarity), "node long, other long")


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("digest"))


def near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, digest (xxhash64 of the text) and component of every row.

    Rows share a component if links of a shingle similarity of at least `similarity` join them. Candidates are what
    SimHash links at 3 bits, as in `simhash`, and, since most pairs at 0.8 differ in more, what MinHash bands bring together.
    Rows of equal shingle sets are one node of the search; null and blank texts are one node.
    """
    named = _named(docs)
    sketches = stored(named.mapInArrow(partial(_sketches, prints=True), f"{SKETCH}, fp long"), "sketches")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    groups = stored(_candidate_groups(sketches, _print_links(sketches)), "candidate-groups")
    first = sketches.groupBy("node").agg(F.min(row).alias("row")).join(groups, "node")
    first = first.select("node", "component", F.col("row.doc_id").alias("_id"), F.col("row.digest").alias("_digest"))
    # Texts that repeat are small files, whose size Spark would take for that of the rows and broadcast them.
    texts = named.join(first.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")))
    found = texts.select("node", "component", "text").mapInArrow(_sets, "node long, component long, hashes binary, minima binary")
    sets = stored(found.dropDuplicates(["node", "component"]), "candidate-sets")
    linked = components(links(sets, similarity))
    rows = sketches.select("doc_id", "digest", "node").join(linked, "node", "left")
    return rows.select("doc_id", "digest", F.coalesce("component", "node").alias("component"))


def without_near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """`docs` with one row of each component of `near_copies`: of least doc_id, then of least text hash.

    A row with null doc_id stays only if its group has no id. Of rows that are equal in doc_id
    and text one stays. All columns are kept, whatever their names; null and blank texts are one
    group; an empty table gives none.
    """
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    best = near_copies(docs, similarity).groupBy("component").agg(F.min(row).alias("row"))
    keep = best.select(F.col("row.doc_id").alias("_id"), F.col("row.digest").alias("_digest"))
    own = carried(docs, _doc=F.col("doc_id").cast("long"), _own=F.xxhash64("text"))
    chosen = own.join(keep, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest")), "left_semi")
    return restored(chosen.dropDuplicates(["_doc", "_own"]), docs)
