"""Mixing sources to target weights by iterative proportional fitting of token weights."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketwork.llm.common import carried, restored, stored, words
from basketwork.llm.sharding import BITS, hash_bits

ROUNDS = 10
# Rounds of raking within the cells' tokens, and the most that a cell's weight may exceed them by.
BOUNDED_ROUNDS, LARGEST_FACTOR = 40, 1e6
# Cells that may come to the driver, some 50 MB; more are refused, so rare sources must be grouped before.
MAX_CELLS = 1_000_000
DIMENSIONS = ("source", "lang", "topic")
# Target shares without given weights are token shares to this power: below 1, small values gain.
EXPONENT = 0.5
KEEP = 0.5
# Topics by what a text holds; the first that matches counts, `prose` if none does.
TOPICS = (("licensed", "[Ll]icense"), ("tables", r"\|.*\|"), ("contacts", "@[a-z0-9-]+[.]"), ("figures", "[0-9]{4}"))


def topic(text: Column) -> Column:
    found = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        found = F.when(text.rlike(pattern), name).otherwise(found)
    return found


def _features(docs: DataFrame) -> dict[str, Column]:
    """Cell columns of a row (null apart from every string) and its tokens: its words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    value = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    own = value("topic") if "topic" in docs.columns else F.concat(F.lit("="), topic(text))
    return {"_source": value("source"), "_lang": value("lang"), "_topic": own, "_tokens": F.size(words(text)).cast("long")}


def _targets(cells: DataFrame, dimension: str, weights: Mapping[str, float] | None) -> DataFrame:
    """value, share: what part of all tokens each value of a dimension is to have."""
    sums = cells.groupBy(dimension).agg(F.sum("_tokens").alias("t"))
    if weights:
        given = F.create_map(*(F.lit(x) for k, v in weights.items() for x in (f"={k}", float(v))))
        weight = F.coalesce(F.try_element_at(given, F.col(dimension)), F.lit(0.0))
    else:
        weight = F.pow(F.col("t").cast("double"), F.lit(EXPONENT))
    rows = sums.select(F.col(dimension), weight.alias("share"))
    whole = rows.agg(F.sum("share")).first()[0] or 1.0
    return rows.select(dimension, (F.col("share") / whole).alias("share"))


def raked(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """`cells` with _weight: token shares scaled, one dimension after the other, to the target shares.

    Every round is stored, so lineage stays short. Sums per value are combined before the shuffle.
    """
    current = cells.withColumn("_weight", F.col("_tokens").cast("double"))
    for dimension, target in targets.items():
        current = current.join(target.withColumnRenamed("share", f"{dimension}_share"), dimension)
    current = stored(current, "raked")
    for _ in range(rounds):
        for dimension in targets:
            sums = current.groupBy(dimension).agg(F.sum("_weight").alias("_sum"))
            scaled = F.when(F.col("_sum") > 0, F.col("_weight") * (F.col(f"{dimension}_share") / F.col("_sum"))).otherwise(0.0)
            current = current.join(sums, dimension).withColumn("_weight", scaled).drop("_sum")
        current = stored(current, "raked")
    return current.drop(*(f"{d}_share" for d in targets))


def reachable(shares: np.ndarray, supply: np.ndarray, total: float) -> np.ndarray:
    """Tokens of each value: `total` by shares; what a value has too little of goes to the others by their shares."""
    goal, free = np.zeros(len(shares)), shares > 0
    while free.any():
        left = max(0.0, total - goal[~free].sum())
        even = np.where(free, shares * (left / shares[free].sum()), goal)
        short = free & (even > supply)
        if not short.any():
            return even
        goal[short], free = supply[short], free & ~short
    return goal


def bounded(
    codes: np.ndarray, tokens: np.ndarray, shares: list[np.ndarray], total: float, rounds: int = BOUNDED_ROUNDS
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Expected tokens of each cell, none above its own, raked to the reachable sums; and those sums.

    `codes` has each cell's value in each dimension. A cell's weight is a product of one factor per value and may
    exceed its tokens, but counts in every sum as its tokens at most, so the fit goes on with the others. If no
    weights meet all sums together, the last round's stand.
    """
    supply = [np.bincount(c, tokens, len(s)) for c, s in zip(codes, shares)]
    total = min([total, *(t[s > 0].sum() for t, s in zip(supply, shares))])
    goals = [reachable(s, t, total) for s, t in zip(shares, supply)]
    weight = tokens.copy()
    for _ in range(rounds):
        for code, goal in zip(codes, goals):
            sums = np.bincount(code, np.minimum(weight, tokens), len(goal))
            factor = np.divide(goal, sums, out=np.zeros(len(goal)), where=sums > 0)
            weight = np.minimum(weight * factor[code], tokens * LARGEST_FACTOR)
    return np.minimum(weight, tokens), goals


def _cells_and_targets(docs: DataFrame, weights: Mapping[str, Mapping[str, float]] | None) -> tuple[DataFrame, dict[str, DataFrame]]:
    cells = stored(
        docs.select(*(c.alias(k) for k, c in _features(docs).items()))
        .groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("_tokens")).filter("_tokens > 0"),
        "cells",
    )
    return cells, {f"_{d}": stored(_targets(cells, f"_{d}", (weights or {}).get(d)), "targets") for d in DIMENSIONS}


def _fitted(cells: DataFrame, targets: Mapping[str, DataFrame], keep: float):
    """Rows of the cells, their expected tokens, and (value, target share, reachable tokens) of each dimension."""
    if (n := cells.count()) > MAX_CELLS:
        raise ValueError(f"{n} cells of source, language and topic, over {MAX_CELLS}: group rare sources first")
    rows = sorted(cells.collect(), key=lambda r: tuple(r[d] for d in targets))
    found = [sorted((r[0], r[1]) for r in target.collect()) for target in targets.values()]
    places = [{v: i for i, (v, _) in enumerate(pairs)} for pairs in found]
    codes = [np.array([at[r[d]] for r in rows], dtype=np.int64) for d, at in zip(targets, places)]
    tokens = np.array([r._tokens for r in rows], dtype=float)
    weight, goals = bounded(codes, tokens, [np.array([s for _, s in pairs]) for pairs in found], keep * tokens.sum())
    return rows, tokens, weight, codes, [[(*pair, g) for pair, g in zip(pairs, goal)] for pairs, goal in zip(found, goals)]


def calibrated(
    docs: DataFrame, keep: float = KEEP, weights: Mapping[str, Mapping[str, float]] | None = None, within_supply: bool = True
) -> DataFrame:
    """One row per source, language and topic: tokens, share, and the probability of its documents.

    The probability is the cell's part of `keep` times all tokens over its own tokens. The parts
    are raked within the cells' tokens: none is above 1, no document is repeated, and what a
    cell or value has too little of comes from others (`margins` tells where). Without
    `within_supply` they are raked as if cells had any number of tokens, then cut at 1.
    The cells, not the documents, come to the driver: at most `MAX_CELLS`, more are refused (ValueError).
    """
    cells, targets = _cells_and_targets(docs, weights)
    if within_supply:
        rows, tokens, weight, _, _ = _fitted(cells, targets, keep)
        whole = float(weight.sum()) or 1.0
        values = [(r._source, r._lang, r._topic, r._tokens, float(w) / whole, round(float(w / t), 6)) for r, w, t in zip(rows, weight, tokens)]
        schema = "_source string, _lang string, _topic string, _tokens long, _share double, _rate double"
        return stored(docs.sparkSession.createDataFrame(values, schema), "rates")
    fitted = raked(cells, targets)
    weight, tokens = fitted.agg(F.sum("_weight"), F.sum("_tokens")).first()
    share = F.col("_weight") / (weight or 1.0)
    rate = share * (keep * (tokens or 0)) / F.col("_tokens")
    return stored(
        fitted.select(
            "_source", "_lang", "_topic", "_tokens", share.alias("_share"), F.round(F.least(rate, F.lit(1.0)), 6).alias("_rate")
        ),
        "rates",
    )


def margins(docs: DataFrame, keep: float = KEEP, weights: Mapping[str, Mapping[str, float]] | None = None) -> DataFrame:
    """dimension, value, target (share), reachable and expected (tokens) of every value of the dimensions.

    Reachable differs from the target's tokens where a value has too few; expected differs from
    reachable where no choice of documents meets all sums together.
    """
    cells, targets = _cells_and_targets(docs, weights)
    _, _, weight, codes, found = _fitted(cells, targets, keep)
    rows = [
        (d, v[1:] if v != "-" else None, float(share), float(goal), float(got))
        for d, code, values in zip(DIMENSIONS, codes, found)
        for (v, share, goal), got in zip(values, np.bincount(code, weight, len(values)))
    ]
    return docs.sparkSession.createDataFrame(rows, "dimension string, value string, target double, reachable double, expected double")


def mixture(
    docs: DataFrame, keep: float = KEEP, weights: Mapping[str, Mapping[str, float]] | None = None, within_supply: bool = True
) -> DataFrame:
    """`docs` with n_tokens, topic, probability and selected.

    Token weights of the cells are raked to the target shares of sources, languages and topics
    (`weights`: given weights by dimension and value, others by `EXPONENT`), within what the cells
    hold unless `within_supply` is off (see `calibrated`). A document is
    selected if its hash, even in 0..1, is below its cell's probability; so reruns agree and
    repeated rows share their fate. Null source, lang or topic is a value of its own. A document
    without words has no tokens to weigh; it gets probability 0. A topic column is used if there
    is one, else topics are found by `TOPICS`. Other columns are kept, clashing result names
    replaced; an empty table gives none.
    """
    rates = calibrated(docs, keep, weights, within_supply).drop("_tokens", "_share")
    own = F.coalesce(F.col("doc_id").cast("string"), F.col("text").cast("string"), F.lit(""))
    draw = hash_bits(F.concat(F.lit("mix:"), own)) / F.lit(float(1 << BITS))
    rows = carried(docs, **_features(docs), _draw=draw).join(rates, ["_source", "_lang", "_topic"], "left")
    rate = F.coalesce("_rate", F.lit(0.0)) * (F.col("_tokens") > 0).cast("double")
    return restored(
        rows, docs, n_tokens=F.col("_tokens"), topic=F.when(F.col("_topic") != "-", F.substr("_topic", F.lit(2))),
        probability=rate, selected=F.col("_draw") < rate,
    )


def sampled(docs: DataFrame, keep: float = KEEP, weights: Mapping[str, Mapping[str, float]] | None = None) -> DataFrame:
    """The selected documents of `mixture`, with the columns of `docs`."""
    used = {c: F.col(c) for c in ("doc_id", "text", "source", "lang", "topic") if c in docs.columns}
    rows = carried(docs, **used)
    return restored(mixture(rows, keep, weights).filter("selected"), docs)
