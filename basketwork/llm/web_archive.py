"""WARC archives of pages, and a two-level index over them: sorted key blocks, and a sparse directory of blocks.

Tasks write archives and index files straight into the shared folder, through `pyarrow.fs`, under names of their
own. What they wrote counts only through the rows they return, which Spark commits: files of a task that was lost
and ran again are never read. The shared folder must be a URI that `pyarrow.fs` opens on every executor (a mounted
path, s3, gs, abfs or hdfs).

A search goes through three sizes, none of which is read whole: the index files (their first keys, one for each
task that wrote the index), the directory of one file (a line for each block), and one compressed block. Each is
searched by bisection; the record itself is then a range read of its archive.
"""

from __future__ import annotations

import datetime as dt
import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from contextlib import closing
from functools import lru_cache
from itertools import islice

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketwork.llm.common import stored
from basketwork.operators.joins import attach, column_bytes

MIN_SHARED_BYTES = 100
ARCHIVE_BYTES = 2**30
BLOCK_LINES = 3000
READ_GAP, READ_BYTES = 2**16, 2**23
SEGMENT_BYTES = 2**26
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = "key string, page_id long, archive string, offset long, length long"
SHARDS = "first_key string, first_page long, directory string"
RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
NO_PAGE = -(2**63) - 1  # sorts before any id, as nulls do in Spark


def url_key(url: Column) -> Column:
    """Sort key of a URL: reversed host without www, port, path and query: `org,example,blog)/a?b`.

    Scheme, user and fragment are left out. A URL without scheme and host is kept behind `-`; null is `-`.
    White space and control characters become %20.
    """
    clean = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7f]+", "%20")
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(:[0-9]+)?([^#]*)"
    host, port, rest = (F.regexp_extract(clean, pattern, i) for i in (1, 2, 3))
    labels = F.reverse(F.split(F.regexp_replace(F.lower(host), r"^www[0-9]*\.", ""), r"\."))
    port = F.when(port.isin(":80", ":443"), "").otherwise(port)
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(host != "", F.concat(F.array_join(labels, ","), port, F.lit(")"), path)).otherwise(F.concat(F.lit("-"), clean))


def _store(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("/"):
        folder = f"/{folder.removeprefix('file:').lstrip('/')}"
    return pyarrow.fs.FileSystem.from_uri(folder)


def payloads(pages: DataFrame, min_bytes: int = MIN_SHARED_BYTES) -> DataFrame:
    """page_id, url, key, payload, payload_bytes, payload_digest and refers_to (null for responses).

    Of equal payloads of at least `min_bytes` bytes, rows with the smallest page_id are responses. Copies are
    found by digest: only digests that occur twice or more are joined back, broadcast if their measured bytes fit
    the session's threshold, else in a join that salts digests with many rows.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    size = F.octet_length("payload").cast("long")
    digest = F.unhex(F.sha2("payload", 256))
    large = rows.select("page_id", F.when(size >= min_bytes, digest).alias("digest")).filter(F.col("digest").isNotNull())
    copies = large.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
    copies = stored(copies.filter("n > 1").drop("n"), "copies")
    rows = rows.select("*", url_key(F.col("url")).alias("key"), size.alias("payload_bytes"), digest.alias("digest"))
    found = attach(rows, copies, "digest", "left", sum(column_bytes(copies).values()), "key", counted=large, min_rows=10_000)
    first = F.when((F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return found.select(
        "page_id", "url", "key", "payload", "payload_bytes", F.lower(F.hex("digest")).alias("payload_digest"), first.alias("refers_to")
    )


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}')}>"


def _header(fields: dict) -> bytes:
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None), "\r\n"]).encode()


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, at: str) -> bytes:
    """One WARC record as a gzip member of its own: a response with its payload, or a revisit without."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url) if url else None
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page_id, digest), "WARC-Date": at, "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha256:{digest}", "X-Page-ID": page_id,
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _record_id(refers_to, digest), "X-Refers-To-Page-ID": refers_to}
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    return gzip.compress(_header(fields) + block + b"\r\n\r\n", mtime=0)


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    data = gzip.decompress(member)
    cut = data.index(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in data[:cut].decode().split("\r\n")[1:])
    block = data[cut + 4 : cut + 4 + int(fields["Content-Length"])]
    if len(data) != cut + 8 + len(block) or data[-4:] != b"\r\n\r\n":
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    return fields, block


def _archive_writer(folder: str, at: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                rows = []
                for r in _rows_of(batch):
                    member = record(r["page_id"], r["url"], r["payload"], r["payload_digest"], r["refers_to"], at)
                    if out is not None and offset + len(member) > limit:
                        out.close()
                        out = None
                    if out is None:
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        store.create_dir(root, recursive=True)
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                        about = b"software: basketwork\r\nformat: WARC File Format 1.1\r\n"
                        fields = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": at}
                        fields |= {"Content-Type": "application/warc-fields", "Content-Length": len(about)}
                        offset = out.write(gzip.compress(_header(fields) + about + b"\r\n\r\n", mtime=0))
                    out.write(member)
                    rows.append((r["key"], r["page_id"], name, offset, len(member)))
                    offset += len(member)
                yield _batch(rows, CAPTURES)
        finally:
            if out is not None:
                out.close()

    return run


def _rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one, payloads as bytes: a batch is never a list of all its texts."""
    rest = batch.drop_columns(["payload"]).to_pylist()
    for values, payload in zip(rest, batch["payload"]):
        yield values | {"payload": payload.as_buffer().to_pybytes()}


_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.record_batch([pa.array(c, _KINDS[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def write_archives(pages: DataFrame, folder: str, at: dt.datetime | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a WARC record for each row into archives below `folder`; returns the captures, as stored.

    `pages` has page_id, url and html; other columns are ignored, whatever their names. Null html is an empty
    payload. A row with a null page_id is a response unless another row with the same large payload has an id;
    rows that repeat the smallest page_id are responses too. Each task fills archives of its own up to
    `archive_bytes`; nothing but rows of repeated payloads' digests is shuffled while those fit a broadcast.
    """
    moment = (at or dt.datetime.now(dt.timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = payloads(pages).select("page_id", "url", "key", "payload", "payload_digest", "refers_to")
    return stored(rows.mapInArrow(_archive_writer(f"{folder}/archives", moment, archive_bytes), CAPTURES), "captures")


def _order(key: str, page_id) -> tuple:
    return key, NO_PAGE if page_id is None else page_id


def _index_writer(folder: str, lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        captures = (row for batch in batches for row in zip(*(batch[c].to_pylist() for c in batch.schema.names)))
        first = next(captures, None)
        if first is None:
            return
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        name, offset, blocks, pending = uuid.uuid4().hex, 0, [], [first]
        with closing(store.open_output_stream(f"{root}/{name}.cdx.gz", compression=None)) as out:
            while pending := pending + list(islice(captures, lines - len(pending))):
                text = "\n".join(json.dumps(row, ensure_ascii=False) for row in pending)
                data = gzip.compress(text.encode(), mtime=0)
                out.write(data)
                blocks.append([*pending[0][:2], offset, len(data)])
                offset, pending = offset + len(data), []
        with closing(store.open_output_stream(f"{root}/{name}.dir.gz", compression=None)) as out:
            out.write(gzip.compress(json.dumps(blocks, ensure_ascii=False).encode(), mtime=0))
        yield _batch([(*first[:2], name)], SHARDS)

    return run


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort captures by key and page into compressed blocks below `folder`; returns the index files, as stored.

    Range partitions are cut by key and page, so a URL with a third of all captures is spread over many files.
    Each file has `block_lines` captures in a block and a directory with the first key and the place of each block.
    """
    rows = captures.select("key", "page_id", "archive", "offset", "length")
    ranged = rows.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "archive", "offset")
    return stored(ranged.mapInArrow(_index_writer(f"{folder}/index", block_lines), SHARDS), "index-files")


class Index:
    """Search in the index files of one folder; keeps the directory and the blocks read last."""

    def __init__(self, folder: str, shards: list[tuple[str, int | None, str]]):
        self.store, self.root = _store(f"{folder}/index")
        self.shards = sorted(shards, key=lambda s: _order(*s[:2]))
        self.first = [_order(*s[:2]) for s in self.shards]
        self.directory, self.block = lru_cache(2)(self._directory), lru_cache(2)(self._block)

    def _directory(self, shard: int) -> tuple[list, list]:
        with self.store.open_input_stream(f"{self.root}/{self.shards[shard][2]}.dir.gz", compression=None) as f:
            blocks = json.loads(gzip.decompress(f.read()))
        return [_order(*b[:2]) for b in blocks], blocks

    def _block(self, shard: int, number: int) -> tuple[list, list]:
        _, _, offset, size = self.directory(shard)[1][number]
        with self.store.open_input_file(f"{self.root}/{self.shards[shard][2]}.cdx.gz") as f:
            lines = [json.loads(line) for line in gzip.decompress(f.read_at(size, offset)).decode().split("\n")]
        return [_order(*line[:2]) for line in lines], lines

    @staticmethod
    def _span(first: list, low: tuple, high: tuple) -> range:
        """Numbers of the pieces that may hold orders from `low` to `high`, by the pieces' first orders."""
        return range(max(0, bisect_left(first, low) - 1), bisect_right(first, high))

    def search(self, key: str, page_id, any_page: bool) -> Iterator[list]:
        """Captures of a key, of one page or of any."""
        low, high = (_order(key, None), (key, float("inf"))) if any_page else (_order(key, page_id),) * 2
        for shard in self._span(self.first, low, high):
            first = self.directory(shard)[0]
            for number in self._span(first, low, high):
                orders, lines = self.block(shard, number)
                yield from lines[bisect_left(orders, low) : bisect_right(orders, high)]


def _searcher(folder: str, shards: list, any_page: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(folder, shards)
        for batch in batches:
            pages = batch["page_id"].to_pylist()
            found = [tuple(line) for key, page in zip(batch["key"].to_pylist(), pages) for line in index.search(key, page, any_page)]
            for i in range(0, len(found), 10_000):
                yield _batch(found[i : i + 10_000], CAPTURES)

    return run


def locate(wanted: DataFrame, folder: str, shards: DataFrame) -> DataFrame:
    """Captures of the wanted URLs: key, page_id, archive, offset, length.

    `wanted` has url and, if only that page's captures are asked for, page_id (null asks for captures without one).
    Repeated questions are asked once. They are sorted, so a task reads neighbouring blocks, each once. The driver
    holds the first key of each index file, of which there are at most `spark.sql.shuffle.partitions`.
    """
    any_page = "page_id" not in wanted.columns
    page = F.lit(None).cast("long") if any_page else F.col("page_id").cast("long")
    asked = wanted.select(url_key(F.col("url").cast("string")).alias("key"), page.alias("page_id")).distinct()
    files = [tuple(r) for r in shards.collect()]
    ranged = asked.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return ranged.mapInArrow(_searcher(folder, files, any_page), CAPTURES)


def _ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """archive, offset, length to read at once, and the records in it; `rows` are by archive and offset."""
    group: list[tuple[int, int]] = []
    archive, begin, end = "", 0, 0
    for name, offset, length in rows:
        if group and (name != archive or offset > end + READ_GAP or offset + length > begin + READ_BYTES):
            yield archive, begin, end - begin, group
            group = []
        if not group:
            archive, begin, end = name, offset, offset
        group.append((offset - begin, length))
        end = max(end, offset + length)
    if group:
        yield archive, begin, end - begin, group


def _content(member: bytes, with_payload: bool) -> tuple:
    """A row of RECORDS; the payload of a response must have the digest its header states."""
    fields, block = parsed(member)
    cut = block.index(b"\r\n\r\n") + 4
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(dict(x.split(": ", 1) for x in block[:cut].decode().strip().split("\r\n")[1:])["Content-Length"])
    whole = fields["WARC-Type"] == "response"
    if whole and (len(block) - cut != size or hashlib.sha256(block[cut:]).hexdigest() != digest):
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    ids = [int(v) if (v := fields.get(name)) is not None else None for name in ("X-Page-ID", "X-Refers-To-Page-ID")]
    payload = block[cut:] if whole and with_payload else None
    return ids[0], fields.get("WARC-Target-URI"), fields["WARC-Type"], size, digest, ids[1], payload


def _fetcher(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        name, file = "", None
        for batch in batches:
            places = list(zip(*(batch[c].to_pylist() for c in ("archive", "offset", "length"))))
            for archive, begin, size, records in _ranges(places):
                if archive != name:
                    if file is not None:
                        file.close()
                    name, file = archive, store.open_input_file(f"{root}/{archive}")
                data = file.read_at(size, begin)
                yield _batch([_content(data[o : o + n], with_payload) for o, n in records], RECORDS)
        if file is not None:
            file.close()

    return run


def fetch(captures: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of captures by range reads; payload is null for revisits and without `with_payload`.

    Captures are dealt out by archive and 64 MiB segment and read in order; neighbours are one read of up to 8 MiB.
    A record or payload that does not agree with its header stops the job (ValueError).
    """
    segment = F.floor(F.col("offset") / SEGMENT_BYTES)
    dealt = captures.select("archive", "offset", "length").repartition("archive", segment).sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(_fetcher(f"{folder}/archives", with_payload), RECORDS)


def archive(pages: DataFrame, folder: str, at: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """Write archives and index below `folder`: the captures and the index files. An empty table writes no file."""
    captures = write_archives(pages, folder, at)
    return captures, build_index(captures, folder)


def lookup(wanted: DataFrame, folder: str, shards: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the wanted URLs (see `locate`), found through the index and read from the archives."""
    return fetch(locate(wanted, folder, shards), folder, with_payload)


def inspect(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Every record of one archive in turn, for a look at a file without its index."""
    store, name = _store(path)
    with store.open_input_stream(name, compression=None) as file:
        data = b""
        while piece := file.read(READ_BYTES):
            data += piece
            while data:
                member = zlib.decompressobj(31)
                member.decompress(data)
                if not member.eof:
                    break
                yield parsed(data[: len(data) - len(member.unused_data)])
                data = member.unused_data
