"""Near-duplicate embeddings: random-hyperplane sign hashing, exact cosines, connected components.

Copies of a vector are one node from the start. Every node gets one code per table, the signs of its
products with random hyperplanes. Nodes of one bucket are compared exactly, in blocks: a bucket is
dealt into chunks of bounded size and each pair of chunks is a unit of work of its own, so no bucket,
however large, ends up in one task. A block yields no pairs: it counts each node's links, and joins
linked nodes to the smallest of their local component. A pair that meets in several tables counts
only in the first of them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from batchwarden.llm.common import attach, stage, table
from batchwarden.llm.components import components

THRESHOLD = 0.9
# A pair exactly at the threshold meets in no table at most this often.
MISS = 0.003
# Expected nodes per bucket, were the codes even; the number of bits follows the number of nodes.
BUCKET = 24
MIN_BITS, MAX_BITS = 6, 30
CHUNK = 512
SEED = 7


def tables_for(nodes: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """Bits per code and number of tables for a number of nodes."""
    bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(max(nodes, 1) / BUCKET))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-meet))


def content_key(vector: np.ndarray | None) -> str | None:
    """What equal vectors share; None for a vector that can link with nothing."""
    if vector is None or not len(vector) or not np.isfinite(vector).all() or not vector.any():
        return None
    return hashlib.blake2b((vector + 0.0).astype("<f8").tobytes(), digest_size=16).hexdigest()


def _vector(values: list | None) -> np.ndarray | None:
    if values is None or any(v is None for v in values):
        return None
    return np.array(values, np.float64)


def _keyed(vectors: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [content_key(_vector(v)) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.string()), batch.column(1)], ["vec_id", "key", "v"])

    return vectors.mapInArrow(run, "vec_id bigint, key string, v array<double>")


def _coded(nodes: DataFrame, bits: int, tables: int) -> DataFrame:
    """Nodes with ``codes``: per table the signs as one integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            codes = []
            for v in batch.column(1).to_pylist():
                if len(v) not in planes:
                    planes[len(v)] = np.random.default_rng((SEED, len(v))).standard_normal((tables * bits, len(v)))
                signs = (planes[len(v)] @ np.array(v) > 0).reshape(tables, bits)
                codes.append((signs @ (1 << np.arange(bits))).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.list_(pa.int32()))], [*batch.schema.names, "codes"])

    return nodes.select("node", "v", "n").mapInArrow(run, "node bigint, v array<double>, n bigint, codes array<int>")


def _blocks(coded: DataFrame) -> DataFrame:
    """One row per node and unit of work (``unit``: table, code and pair of chunks) that it takes part in."""
    bucket = F.concat_ws(":", F.size("v").cast("string"), F.col("t").cast("string"), F.col("code").cast("string"))
    keyed = stage(coded.select("node", "v", F.posexplode("codes").alias("t", "code")).select("node", "t", bucket.alias("bucket")), "codes")
    sizes = stage(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "buckets")
    met = attach(keyed, sizes, "bucket", "size").filter("size IS NOT NULL")
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("node", "t"), chunks).cast("int")
    places = met.select("node", F.struct("t", "bucket", own.alias("own"), chunks.alias("chunks")).alias("place"))
    per_node = places.groupBy("node").agg(F.collect_list("place").alias("places"))  # one per table
    wide = coded.join(per_node, "node").select("node", "v", "n", "codes", F.explode("places").alias("p"))
    others = F.explode(F.sequence(F.lit(0), F.col("p.chunks") - 1)).alias("other")
    each = wide.select("node", "v", "n", "codes", F.col("p.t").alias("t"), F.col("p.bucket").alias("bucket"), F.col("p.own").alias("own"), others)
    unit = F.concat_ws(":", "bucket", F.least("own", "other").cast("string"), F.greatest("own", "other").cast("string"))
    return each.select(unit.alias("unit"), "own", (F.col("own") == F.col("other")).alias("whole"), "t", "node", "n", "v", "codes")


def _links(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Per unit of work and linked node: links to count, and the smallest node of its local component."""
    for rows in _groups(batches):
        found = _compare(rows, threshold)
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["node", "links", "root"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows of one unit, from batches sorted by it. A unit has about two chunks of rows at most."""
    held: list[pa.RecordBatch] = []
    unit = None
    for batch in batches:
        units = batch.column(0).to_pylist()
        begin = 0
        for k, value in enumerate(units):
            if value != unit:
                if k > begin:
                    held.append(batch.slice(begin, k - begin))
                if held:
                    yield pa.Table.from_batches(held)
                held, begin, unit = [], k, value
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def _compare(rows: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    size = rows.num_rows
    if size < 2:
        return None
    column = {name: rows.column(name).combine_chunks() for name in rows.schema.names}
    flat = lambda name: column[name].flatten().to_numpy(zero_copy_only=False).reshape(size, -1)
    vectors, codes = flat("v"), flat("codes")
    node, copies, own = (column[c].to_numpy(zero_copy_only=False) for c in ("node", "n", "own"))
    table = column["t"][0].as_py()
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    length = np.sqrt((vectors * vectors).sum(axis=1))
    near = vectors @ vectors.T >= threshold * np.outer(length, length)
    near = np.triu(near, 1)
    if not column["whole"][0].as_py():
        near &= own[:, None] != own[None, :]
    a, b = np.nonzero(near)
    if not len(a):
        return None
    first = ~(codes[a, :table] == codes[b, :table]).any(axis=1) if table else np.ones(len(a), bool)
    links = np.bincount(a[first], copies[b[first]], size) + np.bincount(b[first], copies[a[first]], size)
    root = node.copy()
    while True:  # pass the smallest node along links until nothing changes
        before = root.copy()
        np.minimum.at(root, a, before[b])
        np.minimum.at(root, b, before[a])
        if (root == before).all():
            break
    linked = np.unique(np.concatenate((a, b)))
    return node[linked], links[linked].astype(np.int64), root[linked]


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(``vec_id``, ``n_links``, ``component_id``, ``kept``) per row.

    Vectors that are null, empty, zero, or hold a null or non-finite component link with nothing, and
    so do rows without vec_id and vectors of different length. Copies link with each other; a row that
    occurs twice is a copy of itself. Every reported link is verified; one exactly at the threshold is
    missed with probability MISS, a closer one less often.
    """
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    members = stage(_keyed(rows), "vectors")
    able = members.filter("key IS NOT NULL AND vec_id IS NOT NULL")
    nodes = stage(able.groupBy("key").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v")), "nodes")
    bits, tables = tables_for(nodes.count())
    coded = stage(_coded(nodes, bits, tables), "coded")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = _blocks(coded).repartition(parts, "unit").sortWithinPartitions("unit")
    found = stage(units.mapInArrow(lambda batches: _links(batches, threshold), "node bigint, links bigint, root bigint"), "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    facts = nodes.join(counts, "node", "left").join(joined, "node", "left")
    facts = facts.select("key", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    placed = attach(able.select("vec_id", "key"), stage(facts, "facts"), "key", "n").select("vec_id", "n_links", "component_id")
    lone = members.filter("key IS NULL OR vec_id IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return placed.unionByName(lone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
