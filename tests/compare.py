"""Run queries against their oracles and compare all rows.

`python tests/compare.py [sf_dir] [name ...]` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value: object) -> object:
    """One form for equal values of both engines."""
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        if math.isnan(number) or math.isinf(number):
            return repr(number)
        return float(f"{number:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when the query and its oracle give the same rows."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows, oracle has {len(expected)}"
    for left, right in zip(actual, expected):
        if left != right:
            bad = [n for n, a, b in zip(sorted(names), left, right) if a != b]
            return f"rows differ in {bad}: {left} / {right}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as contract
    from basketwork.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false", spark_driver_memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(folder), contract.oracle_sql()
    for name, query in contract.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in oracles:
                verdict = difference(df, con, oracles[name]) or "ok"
            else:
                verdict = f"no oracle, {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
