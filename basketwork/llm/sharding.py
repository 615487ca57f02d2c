"""Shards by extendible hashing: a bucket of hash prefixes splits on another bit only if it is too large."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketwork.llm.common import carried, restored, stored

BITS = 60
LIMIT_BYTES = 64 * 1024 * 1024
# Bits beyond an even split that one round looks ahead.
AHEAD = 4


def hash_bits(key: Column) -> Column:
    """60 hash bits of a string, as a long that is not negative."""
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def _binary(bits: str) -> Column:
    return F.lpad(F.conv(F.col(bits).cast("string"), 10, 2), BITS, "0")


def _leaves(cells: DataFrame, depth: int, above: int, limit: int) -> DataFrame:
    """_cell, _depth: the shallowest prefix of each cell, at `above` bits or deeper, that fits; null if none.

    A prefix fits if its rows have at most `limit` bytes or if it is one row.
    """
    at = F.explode(F.sequence(F.lit(above), F.lit(depth))).alias("_depth")
    lines = cells.select("_cell", "_bytes", "_rows", at)
    up = F.expr(f"shiftright(_cell, {depth} - _depth)")
    lines = lines.withColumn("_prefix", up)
    sums = lines.groupBy("_depth", "_prefix").agg(F.sum("_bytes").alias("b"), F.sum("_rows").alias("n"))
    fitting = sums.filter((F.col("b") <= limit) | (F.col("n") == 1)).select("_depth", "_prefix", F.lit(True).alias("fits"))
    joined = lines.join(fitting, ["_depth", "_prefix"], "left")
    return joined.groupBy("_cell").agg(F.expr("min(CASE WHEN fits THEN _depth END)").alias("_depth"))


def _assigned(rows: DataFrame, limit: int, mark: str) -> tuple[list[DataFrame], DataFrame | None]:
    """Rows with _shard, in parts, and the rows (or None) that all 60 bits leave in too large a bucket."""
    total = rows.agg(F.sum("_bytes")).first()[0] or 0
    depth, above, parts, left = 0, 0, [], rows
    step = max(1, math.ceil(math.log2(max(1, total / limit))) + AHEAD)
    while True:
        above, depth = depth, min(BITS, depth + step)
        step = 16
        at_depth = left.withColumn("_cell", F.shiftright("_bits", BITS - depth))
        cells = at_depth.groupBy("_cell").agg(F.sum("_bytes").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        directory = stored(_leaves(cells, depth, above, limit), "shard-directory")
        placed = at_depth.join(directory.filter("_depth IS NOT NULL"), "_cell")
        shard = F.concat(F.lit(mark), F.substr(_binary("_bits"), F.lit(1), F.col("_depth")))
        parts.append(placed.withColumn("_shard", shard).drop("_cell"))
        large = directory.filter("_depth IS NULL").select("_cell")
        if large.isEmpty():
            return parts, None
        left = stored(at_depth.join(large, "_cell", "left_semi").drop("_cell"), "rows-of-large-buckets")
        if depth == BITS:
            return parts, left


def bucketed(rows: DataFrame, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """`rows` with shard_id and shard_depth, from their columns _bits (`hash_bits`) and _bytes, which go.

    shard_id is `s` and the hash-prefix bits of the bucket, `s` alone for one bucket. The
    directory is worked out on bytes per prefix, not on rows: each round sums prefixes a few bits
    deeper than an even split would need, takes the shallowest prefix that fits, and goes on with
    the rows of the buckets that are still too large. Rows that agree in all hash bits, such as
    a repeated id, are dealt by a row number in further bits, after `+`; so every shard fits
    unless it is one row that alone is larger.
    """
    parts, left = _assigned(rows, limit_bytes, "s")
    if left is not None:
        numbered = left.withColumn("_id", F.monotonically_increasing_id().cast("string")).withColumnRenamed("_bits", "_first")
        numbered = stored(numbered, "numbered-rows").withColumn("_bits", hash_bits(F.col("_id")))
        more, _ = _assigned(numbered, limit_bytes, "+")
        parts += [m.withColumn("_shard", F.concat(F.lit("s"), _binary("_first"), "_shard")).drop("_first", "_id") for m in more]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.withColumnsRenamed({"_shard": "shard_id", "_depth": "shard_depth"}).drop("_bits", "_bytes")


def sharded(docs: DataFrame, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """`docs` with n_bytes (UTF-8 of text), shard_id and shard_depth, by `bucketed`.

    Hashed is doc_id, or the text where it is null. Null text has 0 bytes. All rows and columns
    are kept, whatever their names, but shard_id, shard_depth and n_bytes are replaced; an empty table gives none.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.col("text").cast("string"), F.lit(""))
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")
    rows = bucketed(carried(docs, n_bytes=size, _bytes=size, _bits=hash_bits(key)), limit_bytes)
    return restored(rows, docs, **{c: F.col(c) for c in ("n_bytes", "shard_id", "shard_depth")})
