"""Time the headline queries on one machine and print one JSON line.

BENCH_SF_DIR: folder of the sample tables (default /root/testdata/sf0.1).
BENCH_CPUS: cores to use (default 8).

`build_warehouse` covers the whole transform from feeds to stored tables, once and on a
cold JVM. The other entries query the stored warehouse, as the published figures
do; each is the median of three times to plan, run and fetch one result.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

from basketwork.plans.catalogue import ANALYTICS, QUALITY, VALIDATION
from basketwork.plans.warehouse import sample_warehouse
from basketwork.session import build_session

HEADLINE = [
    *((name, VALIDATION[name]) for name in ("v12_country", "v13_multi", "v14_monthly", "v4_v5_fk", "v8_keys")),
    *ANALYTICS.items(),
    *((name, QUALITY[name]) for name in ("q1_uniqueness_warehouse", "q2_completeness", "q5_integrity_report", "q8_results")),
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "basketwork-bench", f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus, spark_ui_enabled="false", spark_driver_memory="8g",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, action, runs: int = 1) -> None:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            action()
            taken.append(time.perf_counter() - start)
        times[name] = round(median(taken), 3)
        print(f"{name}: {times[name]}", file=sys.stderr)

    timed("build_warehouse", lambda: sample_warehouse(spark, sf_dir))
    for name, query in HEADLINE:
        timed(name, lambda: query(spark, sf_dir).collect(), runs=3)
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({
        "metric": "warehouse_build_and_headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
