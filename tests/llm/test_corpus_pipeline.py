from __future__ import annotations

from itertools import combinations
from pathlib import Path

import pytest
from compare import connect, difference

import corpus_pipeline
from basketwork.llm import decontamination, mixing, quality_rules, sharding
from basketwork.llm.common import table
from basketwork.llm.oracles import ORACLES
from basketwork.llm.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="sample tables not present")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    assert difference(QUERIES[name](spark, str(DATA)), connect(str(DATA)), ORACLES[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def least_of_near_copies(docs) -> list[int]:
    """Least id of each group of texts that links of five-word Jaccard similarity 0.8 join, over all pairs of texts."""
    sets = {}
    for r in docs.select("doc_id", "text").collect():
        words = r.text.lower().split()
        sets[r.doc_id] = frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))
    first = {i: i for i in sets}

    def root(i: int) -> int:
        while first[i] != i:
            i = first[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            first[high] = low
    return [i for i in sets if root(i) == i]


def test_stages_one_by_one(spark):
    docs = table(spark, str(DATA), "documents")
    benchmark = table(spark, str(DATA), "benchmark")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    for name, stage in corpus_pipeline.STAGES:
        before, after = ids(docs), stage(spark, docs, str(DATA)).cache()
        if name == "quality":
            want = [r.doc_id for r in quality_rules.quality_report(docs).collect() if r.kept]
        elif name == "near_duplicates":
            want = least_of_near_copies(docs)
        elif name == "decontaminate":
            hit = {r.doc_id for r in decontamination.contaminated(docs, benchmark).collect()}
            want = [i for i in before if i not in hit]
        elif name == "mix":
            want = [r.doc_id for r in mixing.mixture(docs).collect() if r.selected]
        else:
            want, shards = before, {r.doc_id: r.shard_id for r in sharding.sharded(docs).collect()}
            assert shards == {r.doc_id: r.shard_id for r in after.collect()}
        assert ids(after) == sorted(want) and len(want) > 0, name
        assert name == "shard" or after.columns == docs.columns
        docs = after
    whole = corpus_pipeline.run(spark, str(DATA))
    assert ids(whole) == ids(docs)
