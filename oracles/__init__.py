"""DuckDB statements of the same results, used to check the Spark jobs."""

from __future__ import annotations


def all_oracles() -> dict[str, str]:
    from oracles import analytics, checks, features, lineage, monitoring, sources, star

    parts = (star, analytics, checks, lineage, sources, monitoring, features)
    return {name: text for part in parts for name, text in part.ORACLES.items()}
