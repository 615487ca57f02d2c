from __future__ import annotations

import gzip
import hashlib
import random
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from basketwork.llm import queries
from basketwork.llm import web_archive as w
from basketwork.llm.oracles import ARCHIVE

PAGES = "page_id long, url string, html string"
LONG = "<p>copied</p>" * 20
ODD = [
    (5, "http://www.Blog.Example.org:80/a?b=1#c", LONG), (3, "https://blog.example.org/a?b=1", LONG), (9, "http://x.org", LONG),
    (1, None, None), (2, "", ""), (4, "no url at all", "short"), (6, "no url at all", "short"), (7, "http://[bad", "é\r\n\r\nWARC/1.1\r\n" * 30),
    (7, "http://[bad", "é\r\n\r\nWARC/1.1\r\n" * 30), (None, "http://x.org/n", LONG), (None, "http://x.org/n", "n" * 200), (8, "http://x.org/ n\r\nX: y", "z" * 300_000),
]


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame(rows, PAGES)


def expected(rows: list[tuple]) -> list[tuple]:
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == payload and i is not None]
        first = min(same) if same and len(payload) >= 100 else page_id
        kind = "response" if first == page_id else "revisit"
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), kind, first if kind == "revisit" else None))
    return sorted(out, key=str)


def seen(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def many(n: int = 700) -> list[tuple]:
    """Pages of few hosts, a third of them on one URL, and copies in groups of all sizes."""
    rng = random.Random(2)
    rows = []
    for i in range(n):
        url = "http://hot.example.com/" if i % 3 == 0 else f"http://h{rng.randrange(5)}.example.com/{rng.randrange(40)}"
        rows.append((i, url, f"<p>page {i if rng.random() < 0.5 else rng.randrange(9)}</p>" * rng.randrange(4, 9)))
    return rows


@pytest.mark.parametrize("rows", [ODD, many(), []], ids=["odd", "many", "empty"])
def test_records_read_back(pages, tmp_path, rows):
    df, folder = pages(rows).repartition(3), str(tmp_path / "archive")
    captures, shards = w.archive(df, folder)
    assert captures.count() == len(rows)
    back = w.lookup(df, folder, shards)
    assert seen(back) == expected(rows)
    texts = {(i, hashlib.sha256((h or "").encode()).hexdigest()): (h or "").encode() for i, _, h in rows}
    for r in back.filter("record_type = 'response'").collect():
        assert bytes(r.payload) == texts[r.page_id, r.payload_digest]


def test_searches_by_url_equal_brute_force(spark, pages, tmp_path, monkeypatch):
    rows, folder = many(), str(tmp_path / "archive")
    captures = w.write_archives(pages(rows).repartition(4), folder, archive_bytes=20_000)
    assert captures.select("archive").distinct().count() > 8
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = w.build_index(captures, folder, block_lines=7)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert shards.count() > 1
    monkeypatch.setattr(w, "READ_GAP", 100)
    for url in ("http://hot.example.com/", "https://www.h1.example.com:443/7#x", "http://h4.example.com/39", "http://none.org/", None):
        same = url and url.replace("https://www.", "http://").replace(":443", "").split("#")[0]
        found = w.lookup(spark.createDataFrame([(url,), (url,)], "url string"), folder, shards, with_payload=False)
        assert sorted(r.page_id for r in found.collect()) == [i for i, u, _ in rows if u == same]
    one = spark.createDataFrame([("http://hot.example.com/", 3), ("http://hot.example.com/", 4)], "url string, page_id long")
    assert [r.page_id for r in w.lookup(one, folder, shards).collect()] == [3]


def test_archives_are_warc_files(pages, tmp_path):
    w.archive(pages(ODD).coalesce(1), str(tmp_path / "archive"))
    (file,) = Path(tmp_path / "archive/archives").iterdir()
    records = list(w.inspect(str(file)))
    assert [f["WARC-Type"] for f, _ in records].count("revisit") == 3 and records[0][0]["WARC-Type"] == "warcinfo"
    assert gzip.decompress(file.read_bytes()).startswith(b"WARC/1.1\r\n")
    ids = {f["WARC-Record-ID"] for f, _ in records if f["WARC-Type"] == "response"}
    assert all(f["WARC-Refers-To"] in ids for f, _ in records if f["WARC-Type"] == "revisit")
    assert all("\n" not in f.get("WARC-Target-URI", "") for f, _ in records)


def test_damage_is_noticed(pages, tmp_path):
    member = w.record(1, "http://x.org", b"payload", hashlib.sha256(b"other").hexdigest(), None, "2001-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="damaged payload"):
        w._content(member, True)


def test_keys(spark):
    urls = ["http://www.A.example.org:8080/x?y#z", "https://u@b.org", "http://b.org?q", "nothing", "a b", None, "ftp://[bad"]
    keys = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "url string").select(w.url_key(F.col("url"))).collect()]
    assert keys == ["org,example,a:8080)/x?y", "org,b)/", "org,b)/?q", "-nothing", "-a%20b", "-", "[bad)/"]


def test_copies_join_without_broadcast(spark, pages):
    rows, limit = many(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = w.payloads(pages(rows)).select("page_id", "refers_to").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(map(tuple, got)) == sorted((e[0], e[4]) for e in expected(rows))


def test_query_equals_sql(spark, pages, tmp_path):
    rows = [*many(300), *[r for r in ODD if r[0] is not None]]
    pages(rows).write.parquet(f"{tmp_path}/pages.parquet")
    got = seen(queries.op12_web_archive(spark, str(tmp_path)))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(connection.execute(ARCHIVE).fetchall(), key=str)


def test_clashing_columns_are_ignored(pages, tmp_path):
    odd = pages(ODD).withColumns({n: F.lit("x") for n in ("digest", "first", "key", "payload", "refers_to", "n", "archive", "__salt", "offset")})
    _, shards = w.archive(odd, str(tmp_path / "archive"))
    assert seen(w.lookup(odd, str(tmp_path / "archive"), shards)) == expected(ODD)
