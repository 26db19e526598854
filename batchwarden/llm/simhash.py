"""Near-duplicate texts by SimHash fingerprints and covering locality-sensitive hashing.

Bit i of a fingerprint gets a non-zero code of RADIUS + 1 bits. A mask is one non-zero code c and
keeps the bits whose code has odd parity with c. Two fingerprints differing in at most RADIUS bits
have differing codes that cannot span all RADIUS + 1 dimensions, so some c is orthogonal to all of
them, its mask hides every differing bit, and the pair meets in that table: no pair is ever missed.

A bucket with few distinct fingerprints is compared pair by pair. In a larger one pairs would grow
with its square, so its fingerprints are linked through midpoints instead: two of them differ in at
most two bits exactly if they share a value at most one bit away from each. A midpoint has at most 65
such neighbours, whatever the size of the bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from batchwarden.llm.common import attach, stage, table
from batchwarden.llm.components import components
from batchwarden.llm.similar import first_rows, row_key
from batchwarden.operators.membership import possible

BITS = 64
RADIUS = 2
SEED = 42
# Buckets with up to this many distinct fingerprints are compared pair by pair.
SMALL_BUCKET = 32
# Shingles turned into bits at a time, and words hashed at a time.
CHUNK = 1 << 16


def masks(radius: int = RADIUS) -> list[int]:
    """The covering masks as unsigned integers: 2^(radius + 1) - 1 of them."""
    codes = [1 + i % ((2 << radius) - 1) for i in range(BITS)]
    return [sum(1 << i for i, code in enumerate(codes) if (code & c).bit_count() % 2) for c in range(1, 2 << radius)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: str | None, width: int) -> int:
    """The fingerprint of a text: bits set in over half of its shingles' hashes; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    shingle = partial(xxhash.xxh64_intdigest, seed=SEED)
    if len(words) < width:
        return shingle(b" ".join(words))
    total = len(words) - width + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, total, CHUNK):
        part = words[at : at + CHUNK + width - 1]
        columns = (part[k : len(part) - width + 1 + k] for k in range(width))
        hashes = np.fromiter(map(shingle, map(b" ".join, zip(*columns))), np.uint64)
        counts += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(``doc_id``, ``fp``: the fingerprint as a signed long) per row; the text is lower-cased in A-Z."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [_signed(fingerprint(x.as_py(), width)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, fp bigint")


def links(distinct: DataFrame) -> DataFrame:
    """Edges (``src``, ``dst``) that join distinct fingerprints (``fp``, ``node``) exactly as links do.

    A path of edges leads from one fingerprint to another exactly if a path of links does. Each edge
    of a small bucket is a link; those of a large bucket lead to the smallest node of a midpoint.
    """
    tables = F.array(*(F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(masks())))
    keyed = distinct.select("fp", "node", F.explode(tables).alias("b")).select("fp", "node", "b.t", "b.key")
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = stage(keyed.join(sizes, ["t", "key"]), "buckets")
    few = met.filter(F.col("size") <= SMALL_BUCKET)
    other = few.select("t", "key", F.col("fp").alias("fp2"), F.col("node").alias("node2"))
    near = (F.col("node") < F.col("node2")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= RADIUS)
    pairs = few.join(other, ["t", "key"]).filter(near).select(F.col("node").alias("src"), F.col("node2").alias("dst"))
    crowd = met.filter(F.col("size") > SMALL_BUCKET).select("fp", "node").distinct()
    flips = F.array(F.lit(0).cast("bigint"), *(F.lit(_signed(1 << k)) for k in range(BITS)))
    middles = crowd.select("node", F.explode(F.transform(flips, lambda x: x.bitwiseXOR(F.col("fp")))).alias("middle"))
    ends = middles.groupBy("middle").agg(F.collect_set("node").alias("nodes")).filter(F.size("nodes") > 1)
    stars = ends.select(F.array_min("nodes").alias("src"), F.explode("nodes").alias("dst")).filter("src < dst")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(``doc_id``, ``fingerprint``, ``component_id``) per row.

    Fingerprints link at RADIUS or fewer differing bits; ``component_id`` is the smallest doc_id that
    links reach, the row's own included. A null text is an empty one. Texts without words share the
    fingerprint zero. Rows of equal texts share a fingerprint, and all of them one graph node: copies
    are never paired. Rows without doc_id have a fingerprint but take no part in linking; their
    component_id is null. Repeated rows come out repeated.
    """
    rows = stage(fingerprints(docs, doc_id, text, width), "fingerprints")
    known = rows.filter("doc_id IS NOT NULL")
    distinct = stage(known.groupBy("fp").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n")), "distinct")
    # One doc_id may come with several texts, whose fingerprints are then one node.
    found = components(links(distinct.select("fp", "node")).unionByName(_same_id(known, distinct)))
    facts = distinct.join(found, "node", "left").select("fp", "n", F.coalesce("component", "node").alias("component_id"))
    placed = attach(known, stage(facts, "facts"), "fp", "n")
    lone = rows.filter("doc_id IS NULL").select("doc_id", "fp", F.lit(None).cast("bigint").alias("component_id"))
    both = placed.select("doc_id", "fp", "component_id").unionByName(lone)
    return both.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _same_id(known: DataFrame, distinct: DataFrame) -> DataFrame:
    """Edges between the nodes of one doc_id that came with several fingerprints."""
    several = known.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a != b").select("doc_id")
    pairs = known.join(several, "doc_id").select("doc_id", "fp").distinct().join(distinct.select("fp", "node"), "fp")
    return pairs.select(F.col("doc_id").alias("src"), F.col("node").alias("dst"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, three-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=3)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of texts connected by a Jaccard similarity of 0.8 or more, the smallest doc_id's.

    Candidates are texts whose SimHash fingerprints over five-word shingles share a key (see ``similar``);
    these fingerprints are longer than 64 bits, as at that similarity 64 lie too many bits apart for masks
    to tell. Candidates are then compared exactly. All rows take part, each with its own text: one without
    doc_id stays if it is like none with one, and one of those that are like each other; of one doc_id all
    texts stay that are not connected. Of several rows with that doc_id the smallest digest tells.
    """
    own = F.col("doc_id").cast("bigint")
    first = stage(first_rows(docs, width=5).withColumn("kept", F.lit(True)), "first")
    ids = docs.select(own.alias("doc_id")).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    some = first.filter("doc_id IS NOT NULL").select("doc_id", "kept").distinct()
    # Only the rows of a doc_id that is dropped, repeated or missing need to meet; bit maps tell most others.
    listed = stage(ids.join(some, "doc_id", "left").filter("n > 1 OR kept IS NULL").select("doc_id"), "listed")
    # ``possible`` has columns of its own, whose names may be taken: it sees the id and the whole row.
    whole = docs.select(own.alias("doc_id"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    marked = possible(whole, listed, ["doc_id"], "listed")
    is_open = F.col("listed") | F.col("doc_id").isNull()
    # Copies are one row before they meet.
    keyed = marked.filter(is_open).select(row_key(F.col("doc_id"), F.col("row.text")).alias("t"), "row")
    once = keyed.groupBy("t").agg(F.min_by("row", F.sha2(F.to_json("row"), 256)).alias("row"))
    open_rows = once.join(first.select("t"), "t", "left_semi")
    kept = marked.filter(~is_open).select("row.*").unionByName(open_rows.select("row.*"))
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
