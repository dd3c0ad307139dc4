"""WARC archives with a two-level capture index.

Pages are written as gzip-compressed WARC records, one file per task. Each record is listed in
the capture index under its key: the URL with its host reversed, then the page id. The index is
sorted by key over all tasks and cut into shards; a shard is a file of compressed blocks of
lines, with a sparse directory beside it that holds the first key and place of every block.

A lookup sends the wanted keys to their shards, searches the directory of the shard by halves
for the block, reads the range of the block only, and searches its lines by halves. Records
are then read by their ranges in the archives.

Files get new names at every attempt of a task, and only those that the finished attempt
reports are listed, so a lost executor leaves unlisted files and no doubled records. Archives
and index are below a folder that all executors reach (local paths and stores that Arrow
opens by their address).

Defined results: a null payload is empty; of equal payloads of at least ``REVISIT_BYTES``, the
largest page id is a response and the others revisit it, null ids being the smallest; repeated
rows are all written, those of the largest id as responses; a null URL is filed under the page
id; control characters and spaces in URLs are percent-encoded in the record; an empty table
gives an empty archive; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchlake.llm.common import query, settle, table
from pitchlake.session import scratch

REVISIT_BYTES = 1_000
# Lines of one compressed index block.
BLOCK_LINES = 256
# Most index lines of a shard, on average; bounds the directory that a lookup loads.
SHARD_LINES = 1_000_000
# Ranges of an archive that one task reads.
READ_BYTES = 32 << 20
DATE = "1970-01-01T00:00:00Z"
GZIP = 31
ENTRY = "key string, page_id long, file string, offset long, length long, kind string"
RECORD = ("page_id long, url string, kind string, refers_to long, digest string, "
          "payload binary")


def reversed_host(url: str | None) -> str:
    """Sort key of a URL: reversed host, port, path and query."""
    try:
        parts = urlsplit(url or "")
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return url or ""
    if not host:
        return url or ""
    place = ",".join(reversed(host.split(".")))
    if port and (parts.scheme, port) not in (("http", 80), ("https", 443)):
        place += f":{port}"
    return f"{place}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def key_of(url: str | None, page_id: int | None) -> str:
    """Index key: URL key and page id. A line break in a URL must not end an index line."""
    name = reversed_host(url) if url is not None else "urn:page"
    return f"{quote(name, safe=SAFE)} {'-' if page_id is None else page_id}"


# All printable ASCII but the percent sign, space and quotation mark, and nothing else.
SAFE = "".join(chr(c) for c in range(33, 127) if chr(c) not in '%"')


def _whole(value) -> int | None:
    return None if pd.isna(value) else int(value)


def _records(frames: Iterator[pd.DataFrame], open_file, name: str) -> Iterator[pd.DataFrame]:
    out, offset = None, 0
    try:
        for frame in frames:
            lines = []
            for page, url, html, digest, refers in zip(
                    frame["page_id"], frame["url"], frame["payload"], frame["digest"],
                    frame["refers_to"]):
                if out is None:
                    out = open_file(name)
                page, refers = _whole(page), _whole(refers)
                kind = "response" if refers is None else "revisit"
                member = _member(page, url, html.encode(), digest, refers)
                out.write(member)
                lines.append((key_of(url, page), page, name, offset, len(member), kind))
                offset += len(member)
            yield pd.DataFrame(lines, columns=[p.split()[0] for p in ENTRY.split(", ")]).astype(
                {"page_id": "Int64"})
    finally:
        if out is not None:
            out.close()


def record_id(page: int | None) -> str:
    return f"<urn:page:{'-' if page is None else page}>"


def _member(page: int | None, url: str | None, payload: bytes, digest: str,
            refers: int | None) -> bytes:
    """One record as a gzip member."""
    kind = "response" if refers is None else "revisit"
    body = payload if refers is None else b""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    fields = {
        "WARC-Type": kind, "WARC-Record-ID": record_id(page), "WARC-Date": DATE,
        "WARC-Target-URI": record_id(page)[1:-1] if url is None else quote(
            url, safe=SAFE + '%"'),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response"}
    if refers is not None:
        fields["WARC-Refers-To"] = record_id(refers)
        fields["WARC-Profile"] = (
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    fields["Content-Length"] = str(len(http) + len(body))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, GZIP)
    return (packer.compress(head.encode() + http + body + b"\r\n\r\n") + packer.flush())


def parse(member: bytes) -> tuple:
    """Page id, URL, kind, id of the record that a revisit refers to, digest, payload."""
    raw = zlib.decompress(member, GZIP)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")

    def page(text: str | None) -> int | None:
        number = (text or "")[len("<urn:page:"):-1]
        return int(number) if number not in ("", "-") else None

    return (page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], kind,
            page(fields.get("WARC-Refers-To")), digest,
            payload if kind == "response" else None)


class Store:
    """Files below a folder, for tasks."""

    def __init__(self, folder: str):
        self.folder = folder

    def _place(self, name: str):
        return fs.FileSystem.from_uri(f"{self.folder}/{name}")

    def create(self, name: str):
        system, path = self._place(name)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return system.open_output_stream(path, compression=None)

    def open(self, name: str):
        system, path = self._place(name)
        return system.open_input_file(path)


@dataclass
class Archive:
    """Archives and their capture index."""
    folder: str
    entries: DataFrame
    bounds: list[tuple[str, str]]


def payloads(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
             payload_col: str = "html") -> DataFrame:
    """Pages with payload, digest and the page they revisit, null for responses."""
    body = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        body.alias("payload"))
    size: Column = F.octet_length("payload")
    content = F.unhex(F.sha2("payload", 256))
    shared = (rows.filter(size >= REVISIT_BYTES)
              .groupBy(content.alias("__content")).agg(
                  F.max("page_id").alias("__top"), F.count("*").alias("__n"))
              .filter("__n > 1").drop("__n"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("__top")), F.col("__top"))
    key = F.when(size >= REVISIT_BYTES, content)
    return (rows.withColumn("__content", key).join(shared, "__content", "left")
            .select("page_id", "url", "payload", F.sha1("payload").alias("digest"),
                    refers.alias("refers_to")))


def write(pages: DataFrame, folder: str, shard_lines: int = SHARD_LINES) -> Archive:
    """Write the rows of ``payloads`` as archives and index them."""
    store = Store(folder)

    def records(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _records(frames, store.create, f"archive/{uuid.uuid4().hex}.warc.gz")

    entries = settle(pages.mapInPandas(records, ENTRY), "entries")
    return index(entries, folder, shard_lines)


def index(entries: DataFrame, folder: str, shard_lines: int = SHARD_LINES) -> Archive:
    """Sort entries by key into shards of compressed blocks with sparse directories."""
    store = Store(folder)
    least = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(least, math.ceil(entries.count() / shard_lines))

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, out, offset, first, lines, directory = uuid.uuid4().hex, None, 0, "", [], []

        def flush():
            nonlocal offset
            packed = zlib.compress("\n".join(lines).encode())
            out.write(packed)
            directory.append([lines[0].split("\t", 1)[0], offset, len(packed)])
            offset += len(packed)
            lines.clear()

        for frame in frames:
            for entry in frame.itertuples(index=False):
                if out is None:
                    out, first = store.create(f"index/{name}.blocks"), entry.key
                lines.append("\t".join(map(str, (
                    entry.key, entry.file, entry.offset, entry.length, entry.kind))))
                if len(lines) >= BLOCK_LINES:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        out.close()
        with store.create(f"index/{name}.directory") as file:
            file.write(json.dumps(directory).encode())
        yield pd.DataFrame({"first": [first], "name": [name]})

    found = (entries.repartitionByRange(shards, "key", "file", "offset")
             .sortWithinPartitions("key", "file", "offset")
             .mapInPandas(blocks, "first string, name string"))
    # One row per shard on the driver.
    bounds = sorted((r["first"], r["name"]) for r in settle(found, "bounds").collect())
    return Archive(folder, entries, bounds)


def lookup(archive: Archive, keys: DataFrame) -> DataFrame:
    """Captures of distinct keys (column key), through the two levels of the index."""
    store, bounds = Store(archive.folder), archive.bounds
    firsts = [first for first, _ in bounds]

    # A key can end one shard and start the next ones.
    @F.pandas_udf("array<int>")
    def shards_of(wanted: pd.Series) -> pd.Series:
        return pd.Series([list(range(max(0, bisect_left(firsts, k) - 1), bisect_right(firsts, k)))
                          for k in wanted])

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, reader, starts, directory, held, lines, heads = -1, None, [], [], -1, [], []
        for frame in frames:
            found = []
            for shard, key in zip(frame["shard"], frame["key"]):
                if shard != at:
                    name = bounds[shard][1]
                    with store.open(f"index/{name}.directory") as file:
                        directory = json.loads(file.read())
                    reader = store.open(f"index/{name}.blocks")
                    starts, at, held = [b[0] for b in directory], shard, -1
                block = max(0, bisect_left(starts, key) - 1)
                while block < len(starts) and starts[block] <= key:
                    if block != held:
                        _, offset, length = directory[block]
                        reader.seek(offset)
                        lines = [line.split("\t") for line in
                                 zlib.decompress(reader.read(length)).decode().split("\n")]
                        heads, held = [line[0] for line in lines], block
                    for line in lines[bisect_left(heads, key):bisect_right(heads, key)]:
                        page = line[0].rsplit(" ", 1)[1]
                        found.append((line[0], None if page == "-" else int(page), line[1],
                                      int(line[2]), int(line[3]), line[4]))
                    block += 1
            yield pd.DataFrame(found, columns=[p.split()[0] for p in ENTRY.split(", ")]).astype(
                {"page_id": "Int64"})

    if not bounds:
        return archive.entries.limit(0)
    return (keys.withColumn("shard", F.explode(shards_of("key"))).repartition("shard")
            .sortWithinPartitions("shard", "key").mapInPandas(search, ENTRY))


def read(archive: Archive, captures: DataFrame) -> DataFrame:
    """Records of captures, by range reads in the order of the files."""
    store = Store(archive.folder)

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, reader = None, None
        for frame in frames:
            found = []
            for name, offset, length in zip(frame["file"], frame["offset"], frame["length"]):
                if name != at:
                    at, reader = name, store.open(name)
                reader.seek(offset)
                found.append(parse(reader.read(length)))
            yield pd.DataFrame(found, columns=[p.split()[0] for p in RECORD.split(", ")]).astype(
                {"page_id": "Int64", "refers_to": "Int64"})

    part = F.floor(F.col("offset") / READ_BYTES)
    return (captures.repartition("file", part).sortWithinPartitions("file", "offset")
            .mapInPandas(fetch, RECORD))


def keys_of(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Distinct index keys of pages."""
    @F.pandas_udf("string")
    def key(urls: pd.Series, ids: pd.Series) -> pd.Series:
        return pd.Series([key_of(u, None if i is None else int(i)) for u, i in zip(urls, ids)],
                         dtype=object)

    return pages.select(key(url_col, F.col(id_col).cast("string")).alias("key")).distinct()


ORACLE = """
with p as (
  select page_id, coalesce(html, '') as body, strlen(coalesce(html, ''))::bigint as n from pages),
g as (select body, max(page_id) as top from p group by body)
select page_id, n as payload_bytes, sha1(body) as payload_digest,
       case when n >= 1000 and page_id is distinct from top then 'revisit' else 'response' end
         as record_type,
       case when n >= 1000 and page_id is distinct from top then top end as refers_to
from p join g using (body)
"""


@query("op5_warc", ORACLE)
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    archive = write(payloads(pages), scratch(spark, "warc"))
    records = read(archive, lookup(archive, keys_of(pages)))
    found = settle(records.select(
        "page_id", "kind", "refers_to",
        F.when(F.col("kind") == "response", F.octet_length("payload")).cast("long").alias("n"),
        F.when(F.col("kind") == "response", F.sha1("payload")).alias("sha1")), "records")
    originals = found.filter("kind = 'response' and n >= %d" % REVISIT_BYTES).groupBy(
        F.col("page_id").alias("refers_to")).agg(
            F.max("n").alias("__n"), F.max("sha1").alias("__sha1"))
    # Responses have nothing to look up; joined along, they would all meet at the null key.
    responses = found.filter("kind = 'response'").select(
        "page_id", F.col("n").alias("payload_bytes"), F.col("sha1").alias("payload_digest"),
        F.col("kind").alias("record_type"), "refers_to")
    revisits = found.filter("kind = 'revisit'").join(originals, "refers_to", "left").select(
        "page_id", F.col("__n").alias("payload_bytes"), F.col("__sha1").alias("payload_digest"),
        F.col("kind").alias("record_type"), "refers_to")
    return responses.unionByName(revisits)
