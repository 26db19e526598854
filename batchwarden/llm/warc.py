"""WARC archives of pages and a two-level capture index over them.

Every page becomes a WARC 1.1 record, compressed as a gzip member of its own. Records are gathered
into segments, which are the units of a range read: the archive is a Parquet table with one segment
per row, and the segments of one archive, put together in order, are a ``.warc.gz`` file.

The index sorts captures by their key, the URL with its host reversed, into compressed blocks, and
keeps a sparse directory of the first key of each. A lookup finds its index part among the bounds of
the parts, its block by binary search in that part's directory, then its line in the block, and reads
only the segments and byte ranges these lines name.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from batchwarden.llm.common import attach, stage, table
from batchwarden.session import shared_folder

SEGMENT_BYTES = 1 << 20
BLOCK_LINES = 256
LEVEL = 6
# A WARC record needs a date; the archives are written at no particular one.
DATE = "2000-01-01T00:00:00Z"
RECORD = re.compile(rb"\r\n\r\n")
MISSING = 2**63 - 1


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """The sort key of a URL: reversed host, then path and query, lower case; empty for none."""
    try:
        parts = urlsplit((url or "").strip().lower())
        host = ",".join(reversed((parts.hostname or "").split(".")))
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return (url or "").lower()
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{host}{port}){rest}" if host else (url or "").lower()


def _header(text: str | None) -> str:
    """A header value on one line."""
    return re.sub(r"[\r\n]+", " ", text or "")


def record(page_id: int | None, url: str | None, payload: bytes, own: str, first: int | None) -> bytes:
    """One record as a gzip member: a response with its payload, or a revisit of page ``first``."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_header(url)}",
        f"WARC-Payload-Digest: sha1:{own}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if first is not None:
        lines += [f"WARC-Refers-To: <urn:page:{first}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (payload if first is None else b"")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0)


def parse(member: bytes) -> dict:
    """What a gzip member's record says: page, type, digest and length of the payload, the page it refers to.

    A response's digest and length are taken from its payload, and must agree with its headers.
    """
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    own, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    if fields["WARC-Type"] == "response" and (digest(payload), len(payload)) != (own, size):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    number = lambda name: int(m[1]) if (m := re.search(r":(-?\d+)>$", fields.get(name, ""))) else None
    return {"page_id": number("WARC-Record-ID"), "payload_bytes": size, "payload_digest": own, "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To")}


@dataclass(frozen=True)
class Archive:
    """A written archive: ``segments``, ``blocks`` and ``directory`` under a folder of the shared store."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        """One of the three tables."""
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def bounds(self) -> list[str]:
        """The first key of every index part: at most one string per part."""
        rows = self.table("directory").groupBy("part").agg(F.min("first_key").alias("k")).orderBy("part").collect()
        return [row.k for row in rows]


def _payload_key() -> Column:
    return F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).alias("digest")


def decisions(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(``page_id``, ``digest``, ``refers_to``): the first page of equal payloads, for all but that page.

    The digest belongs to the decision, as rows of one page_id may differ in their payload.

    Only digests and counts are grouped, and combined before they are shuffled; a payload that a third
    of all pages share is attached to them by a broadcast of its one row.
    """
    seen = pages.select("page_id", _payload_key(), F.octet_length(F.coalesce("html", F.lit(""))).alias("size"))
    seen = stage(seen, "digests")
    able = seen.filter(F.col("page_id").isNotNull() & (F.col("size") >= min_bytes))
    firsts = able.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    placed = attach(able.select("page_id", "digest"), stage(firsts.filter("n > 1"), "firsts"), "digest", "n")
    return placed.filter("page_id != first").select("page_id", "digest", F.col("first").alias("refers_to")).distinct()


def write(pages: DataFrame, min_bytes: int = 0) -> Archive:
    """Write archive and index of ``pages`` (``page_id``, ``url``, ``html``; null html is empty).

    Of pages with equal payloads of at least ``min_bytes`` the one with the smallest page_id is a
    response and others revisit it. Pages without page_id are responses. Repeated rows of a page are
    archived each. Other columns are not read.
    """
    spark = pages.sparkSession
    archive = Archive(spark, f"{shared_folder(spark)}/batchwarden-llm/warc-{uuid.uuid4().hex}")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    # Rows without page_id meet no decision; the digest spreads them.
    joined = rows.withColumn("digest", _payload_key()).join(decisions(rows, min_bytes), ["page_id", "digest"], "left")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        body, lines = bytearray(), []

        def segment() -> pa.RecordBatch:
            nonlocal number
            row = {"archive": task, "segment": number, "lines": list(lines), "body": bytes(body)}
            number += 1
            body.clear()
            lines.clear()
            return pa.RecordBatch.from_pylist([row], schema=SEGMENT_ARROW)

        for batch in batches:
            for page_id, url, html, first in zip(*(column.to_pylist() for column in batch.columns)):
                payload = (html or "").encode("utf-8", "replace")
                member = record(page_id, url, payload, digest(payload), first)
                lines.append({"key": url_key(url), "page_id": page_id, "offset": len(body), "length": len(member)})
                body += member
                if len(body) >= SEGMENT_BYTES:
                    yield segment()
        if lines:
            yield segment()

    columns = joined.select("page_id", "url", "html", "refers_to")
    columns.mapInArrow(segments, SEGMENT).write.option("compression", "none").parquet(f"{archive.folder}/segments")
    _write_index(archive)
    return archive


SEGMENT = "archive int, segment int, lines array<struct<key:string,page_id:bigint,offset:bigint,length:bigint>>, body binary"
SEGMENT_ARROW = pa.schema(
    {"archive": pa.int32(), "segment": pa.int32()}
    | {"lines": pa.list_(pa.struct({"key": pa.string(), "page_id": pa.int64(), "offset": pa.int64(), "length": pa.int64()})), "body": pa.binary()}
)
INDEX = "part int, block int, first_key string, n int, payload binary"


def _write_index(archive: Archive) -> None:
    """Sort the captures into compressed blocks, and the blocks' first keys into the directory.

    Captures of one key are ordered by page and place; a key that fills several blocks, even several
    parts, is found by the bounds on both sides.
    """
    lines = archive.table("segments").select("archive", "segment", F.explode("lines").alias("l")).select("l.*", "archive", "segment")
    parts = int(archive.spark.conf.get("spark.sql.shuffle.partitions"))
    order = ("key", "page_id", "archive", "segment", "offset")
    ordered = lines.select("key", "page_id", "archive", "segment", "offset", "length").repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []

        def block(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            payload = zlib.compress("\n".join(json.dumps(row) for row in rows).encode())
            columns = [[part], [number], [rows[0][0]], [len(rows)], [payload]]
            number += 1
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "block", "first_key", "n", "payload"])

        for batch in batches:
            held += zip(*(column.to_pylist() for column in batch.columns))
            while len(held) >= BLOCK_LINES:
                yield block(held[:BLOCK_LINES])
                del held[:BLOCK_LINES]
        if held:
            yield block(held)

    ordered.mapInArrow(blocks, INDEX).write.option("compression", "none").parquet(f"{archive.folder}/blocks")
    archive.table("blocks").select("part", "block", "first_key").write.parquet(f"{archive.folder}/directory")


def lookup(archive: Archive, urls: DataFrame, url: str = "url") -> DataFrame:
    """All captures of the given URLs: (``key``, ``page_id``, ``archive``, ``segment``, ``offset``, ``length``).

    Keys are made distinct first, so a URL that is asked for often is searched once. URLs that were
    never captured give no row; a null URL finds captures without one.
    """
    bounds = archive.bounds()

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [url_key(x.as_py()) for x in batch.column(0)]
            found = [(key, part) for key in keys for part in _candidates(bounds, key)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()), pa.array([p for _, p in found], pa.int32())], ["key", "place"])

    places = archive.table("directory").select("part").distinct().orderBy("part").collect()  # one row per part
    parts = F.array(*(F.lit(row.part) for row in places)) if places else F.array().cast("array<int>")
    wanted = urls.select(F.col(f"`{url}`").alias("url")).distinct().mapInArrow(locate, "key string, place int").distinct()
    wanted = wanted.select("key", F.get(parts, F.col("place")).alias("part"))

    def search(left: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in left:
            for row in batch.to_pylist():
                keys = [x["first_key"] for x in row["blocks"]]
                found = [(key, row["blocks"][k]["block"]) for key in row["keys"] for k in _candidates(keys, key)]
                yield pa.RecordBatch.from_pylist([{"part": row["part"], "block": b, "key": key} for key, b in found], schema=pa.schema({"part": pa.int32(), "block": pa.int32(), "key": pa.string()}))

    directory = archive.table("directory").groupBy("part").agg(F.sort_array(F.collect_list(F.struct("block", "first_key"))).alias("blocks"))
    # Keys of one part are searched in groups of bounded size, each beside the part's directory.
    asked = wanted.groupBy("part", F.pmod(F.xxhash64("key"), F.lit(SALT)).alias("salt")).agg(F.collect_list("key").alias("keys"))
    hits = asked.join(directory, "part").select("part", "keys", "blocks").mapInArrow(search, "part int, block int, key string")
    by_block = hits.groupBy("part", "block").agg(F.collect_set("key").alias("keys"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = set(row["keys"])
                found = [x for x in map(json.loads, zlib.decompress(row["payload"]).decode().split("\n")) if x[0] in keys]
                columns = list(zip(*found)) if found else [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS)], NAMES)

    return by_block.join(archive.table("blocks"), ["part", "block"]).select("keys", "payload").mapInArrow(lines, "key string, page_id bigint, archive int, segment int, offset bigint, length bigint")


SALT = 8
NAMES = ["key", "page_id", "archive", "segment", "offset", "length"]
KINDS = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())


def _candidates(firsts: list[str], key: str) -> range:
    """The places in a sorted list of first keys where a key may lie."""
    low = max(0, bisect.bisect_left(firsts, key) - 1)
    return range(low, bisect.bisect_right(firsts, key))


def read(archive: Archive, captures: DataFrame) -> DataFrame:
    """The parsed records that captures point at, read by segment and byte range."""
    spans = captures.groupBy("archive", "segment").agg(F.collect_list(F.struct("offset", "length")).alias("spans"))
    wanted = archive.table("segments").select("archive", "segment", "body").join(spans, ["archive", "segment"])
    schema = pa.schema({"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, ranges in zip(batch.column(0), batch.column(1).to_pylist()):
                whole = memoryview(body.as_buffer())
                rows = [parse(bytes(whole[x["offset"] : x["offset"] + x["length"]])) for x in ranges]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return wanted.select("body", "spans").mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived, then every URL looked up in the index and its records read back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archive = write(pages)
    return read(archive, lookup(archive, pages.select("url")))
