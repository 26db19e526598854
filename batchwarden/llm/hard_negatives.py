"""Hard negatives of anchors, found through rotated one-bit codes with deterministic intervals.

Every vector is turned by a fixed rotation and kept as the signs of its components, with its length
along that code vector (its alignment) and the length of the rest. For an anchor, turned the same way
and rounded to a few bit planes, popcounts give its length along a row's code vector. The product of
both lengths estimates the inner product. What is left is the product of two rests, which by
Cauchy-Schwarz lies within the product of their lengths; with the rounding of the anchor and of the
arithmetic that gives an interval which holds the exact score for certain. Only rows whose interval
reaches what is wanted are scored, on integers, so the result is exact.

Rows are packed into slices. All anchors, in blocks, visit every slice once for their positives and
once for their negatives; each visit hands on a few rows per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from batchwarden.llm.common import stage, table

SCALE = 256  # components become whole numbers of 1 / SCALE
EVERY = 100  # vec_ids divisible by it are anchors
SHIFTED, LABELS = 7, 10  # where vec_id is divisible by the first, the label moves on by one
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100  # negatives score this many percent of the positive at least and at most
SLICE = 16384  # rows held at once
BLOCK = 256  # anchors that visit a slice together
PLANES = 4  # bit planes of an anchor
SAFE = float(1 << 52)  # scores below it are exact in double precision
LONGEST = (1 << 63) - 1

SLICES = "slice bigint, dim int, n int, ids binary, labels binary, vectors binary, codes binary, alignment binary, rest binary"
ANCHORS = "block bigint, dim int, n int, ids binary, labels binary, vectors binary"
POSITIVE = "anchor_id bigint, dim int, label bigint, vector binary, positive_id bigint, positive_score bigint"
WANTED = "block bigint, dim int, n int, ids binary, labels binary, vectors binary, positive_ids binary, positive_scores binary, counts binary"
NEGATIVE = "anchor_id bigint, place int, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def rotation(dim: int) -> np.ndarray:
    """The orthogonal matrix of a dimension, the same in every task."""
    turned, upper = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return turned * np.sign(np.diag(upper))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sign bits as 64-bit words, alignment with the code vector, and length of the rest, per row."""
    turned = vectors @ turn
    n, dim = turned.shape
    bits = np.zeros((n, -(-max(dim, 1) // 64) * 64), np.uint8)
    bits[:, :dim] = turned >= 0
    codes = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    aligned = np.abs(turned).sum(axis=1) / np.sqrt(max(dim, 1))
    rest = np.sqrt(np.maximum((turned**2).sum(axis=1) - aligned**2, 0.0))
    return codes, aligned, rest


def intervals(anchor: np.ndarray, turn: np.ndarray, codes: np.ndarray, aligned: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends around the inner product of one anchor with every coded row."""
    dim = len(anchor)
    turned = anchor @ turn
    root = np.sqrt(max(dim, 1))
    low = turned.min(initial=0.0)
    step = (turned.max(initial=0.0) - low) / ((1 << PLANES) - 1) or 1.0
    steps = np.rint((turned - low) / step).astype(np.uint64)
    rounding = np.abs(turned - (low + step * steps)).sum() / root
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    weighted = np.zeros(len(codes), np.int64)
    padded = np.zeros((PLANES, codes.shape[1] * 64), np.uint8)
    for plane in range(PLANES):
        padded[plane, :dim] = (steps >> np.uint64(plane)) & np.uint64(1)
    planes = np.packbits(padded, axis=1, bitorder="little").view("<u8")
    for plane in range(PLANES):
        weighted += np.bitwise_count(codes & planes[plane]).sum(axis=1, dtype=np.int64) << plane
    along = (low * (2.0 * ones - dim) + step * (2.0 * weighted - float(steps.sum()))) / root
    squared = float((turned**2).sum())
    least = np.maximum(np.abs(along) - rounding, 0.0)
    spread = aligned * rounding + rest * np.sqrt(np.maximum(squared - least**2, 0.0))
    spread += 1e-9 * (1.0 + np.sqrt(squared) * (aligned + rest))
    middle = aligned * along
    return middle - spread, middle + spread


def _scores(vectors: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond double precision by whole numbers of any size."""
    largest = max(np.abs(vectors).max(initial=0.0), 1.0) * max(np.abs(anchor).max(initial=0.0), 1.0)
    if largest * max(len(anchor), 1) < SAFE:
        return np.rint(vectors @ anchor).astype(np.int64)
    whole = [int(x) for x in anchor]
    return np.array([sum(int(x) * y for x, y in zip(row, whole)) for row in vectors], object)


def _best(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the highest scores, ties by smaller id."""
    if len(scores) > 4 * count and scores.dtype != object:
        kth = np.partition(scores, len(scores) - count)[len(scores) - count]
        chosen = np.flatnonzero(scores >= kth)
    else:
        chosen = np.arange(len(scores))
    return np.array(sorted(chosen.tolist(), key=lambda i: (-int(scores[i]), int(ids[i])))[:count], np.int64)


def _fitting(score) -> int:
    return max(-LONGEST - 1, min(LONGEST, int(score)))


def _pack(vectors: np.ndarray) -> bytes:
    """Whole components in 32 bits where they all fit, else in double precision."""
    small = np.abs(vectors).max(initial=0.0) < 1 << 31
    return (b"i" if small else b"d") + vectors.astype("<i4" if small else "<f8").tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    flat = np.frombuffer(data, "<i4" if data[:1] == b"i" else "<f8", offset=1)
    return flat.astype(np.float64).reshape(n, -1) if len(flat) else np.zeros((n, 0))


def _usable(embeddings: DataFrame) -> DataFrame:
    """The rows that take part: (vec_id, label, whole components)."""
    component = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    given = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    given = given.filter(~F.coalesce(bad, F.lit(True)))
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % SHIFTED == 0, (label + 1) % LABELS).otherwise(label)
    return given.select(F.col("vec_id").cast("bigint").alias("vec_id"), moved.alias("label"), component.alias("vector"))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """The rows of a batch by dimension: dimension, ids, labels, vectors."""
    ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
    vectors = batch.column("vector")
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        yield int(dim), ids[rows], labels[rows], flat[starts[rows][:, None] + np.arange(dim)]


def _packer(schema_ddl: str, size: int, coded: bool):
    """Packs rows of one dimension into records of at most ``size`` rows."""
    schema = _arrow(schema_ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}
        counts: dict[int, int] = {}

        def record(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids, labels, vectors = (np.concatenate(x) for x in zip(*held.pop(dim)))
            counts.pop(dim)
            row = [number, dim, len(ids), ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), _pack(vectors)]
            if coded:
                codes, aligned, rest = encode(vectors.reshape(len(ids), dim), rotation(dim))
                row += [codes.tobytes(), aligned.tobytes(), rest.tobytes()]
            number += 1
            return _table([tuple(row)], schema)

        for batch in batches:
            for dim, ids, labels, vectors in _rows(batch):
                at = 0
                while at < len(ids):
                    take = min(size - counts.get(dim, 0), len(ids) - at)
                    held.setdefault(dim, []).append((ids[at : at + take], labels[at : at + take], vectors[at : at + take]))
                    counts[dim] = counts.get(dim, 0) + take
                    at += take
                    if counts[dim] == size:
                        yield record(dim)
        for dim in list(held):
            yield record(dim)

    return run


class _Slice:
    """One slice of rows, unpacked."""

    def __init__(self, r: dict) -> None:
        n, dim = r["n"], r["dim"]
        self.dim = dim
        self.ids, self.labels = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["labels"], "<i8")
        self.vectors = _unpack(r["vectors"], n)
        self.codes = np.frombuffer(r["codes"], "<u8").reshape(n, -1)
        self.aligned, self.rest = np.frombuffer(r["alignment"], "<f8"), np.frombuffer(r["rest"], "<f8")
        self.by_label = {int(k): np.flatnonzero(self.labels == k) for k in np.unique(self.labels)}


def _visits(batches: Iterator[pa.RecordBatch], visit, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Records sorted by slice, the slice itself before the anchors that visit it."""
    here, turns = None, {}
    for batch in batches:
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            if r["codes"] is not None:
                here = _Slice(r)
                continue
            if here is None or here.dim != r["dim"]:
                continue
            turn = turns.setdefault(r["dim"], rotation(r["dim"]))
            ids = np.frombuffer(r["ids"], "<i8").tolist()
            labels = np.frombuffer(r["labels"], "<i8").tolist()
            vectors = _unpack(r["vectors"], r["n"])
            found = []
            for j in range(r["n"]):
                found += visit(here, turn, r, j, ids[j], labels[j], vectors[j])
            yield _table(found, schema)


def _positives(here: _Slice, turn: np.ndarray, r: dict, j: int, anchor: int, label: int, vector: np.ndarray) -> list[tuple]:
    """The best rows of the anchor's own label in one slice."""
    rows = here.by_label.get(label, np.zeros(0, np.int64))
    rows = rows[here.ids[rows] != anchor]
    if len(rows) > POSITIVES:
        low, high = intervals(vector, turn, here.codes[rows], here.aligned[rows], here.rest[rows])
        rows = rows[high >= np.partition(low, len(low) - POSITIVES)[len(low) - POSITIVES]]
    scores = _scores(here.vectors[rows], vector)
    kept = _pack(vector)
    best = _best(scores, here.ids[rows], POSITIVES)
    return [(anchor, here.dim, label, kept, int(here.ids[rows[i]]), _fitting(scores[i])) for i in best]


def _negatives(here: _Slice, turn: np.ndarray, r: dict, j: int, anchor: int, label: int, vector: np.ndarray) -> list[tuple]:
    """The best rows of other labels in one slice within the band below each positive."""
    counts = np.frombuffer(r["counts"], "<i8")
    begin = int(counts[:j].sum())
    ids = np.frombuffer(r["positive_ids"], "<i8")[begin : begin + int(counts[j])].tolist()
    wanted = np.frombuffer(r["positive_scores"], "<i8")[begin : begin + int(counts[j])].tolist()
    bands = [p for p in wanted if p >= 0]  # below zero the band is empty
    if not bands:
        return []
    low, high = intervals(vector, turn, here.codes, here.aligned, here.rest)
    near = (HIGH * high >= LOW * min(bands)) & (low <= max(bands)) & (here.labels != label)
    rows = np.flatnonzero(near)
    scores = _scores(here.vectors[rows], vector)
    found = []
    for place, (positive, p) in enumerate(zip(ids, wanted)):
        if p < 0:
            continue
        inside = np.flatnonzero((scores * HIGH >= LOW * p) & (scores <= p))
        best = inside[_best(scores[inside], here.ids[rows[inside]], NEGATIVES)]
        found += [(anchor, place, positive, p, int(here.ids[rows[i]]), _fitting(scores[i])) for i in best]
    return found


def _visited(slices: DataFrame, anchors: DataFrame, visit, ddl: str) -> DataFrame:
    """Every block of anchors in every slice: a stated set of queries against all rows, block by block."""
    schema = _arrow(ddl)
    n_slices = slices.count()
    numbered = slices.join(slices.select("slice", (F.row_number().over(Window.orderBy("slice")) - 1).alias("place")), "slice")
    everywhere = anchors.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(max(n_slices - 1, 0)))))
    both = numbered.unionByName(everywhere, allowMissingColumns=True)
    laid = both.repartition(max(n_slices, 1), "place")
    laid = laid.sortWithinPartitions("place", F.col("codes").isNull(), "block")
    return laid.mapInArrow(lambda batches: _visits(batches, visit, schema), ddl)


def _first(df: DataFrame, by: list[str], score: str, tie: str, count: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors with their positives, packed in blocks."""
    schema, number = _arrow(WANTED), TaskContext.get().partitionId() << 32
    for batch in batches:
        rows = batch.to_pylist()
        for dim in sorted({r["dim"] for r in rows}):
            own = [r for r in rows if r["dim"] == dim]
            for at in range(0, len(own), BLOCK):
                part = own[at : at + BLOCK]
                pack = lambda values: np.array(values, "<i8").tobytes()
                positives = [p for r in part for p in r["positives"]]
                row = (number, dim, len(part), pack([r["anchor_id"] for r in part]), pack([r["label"] for r in part]))
                row += (_pack(np.stack([_unpack(r["vector"], 1)[0] for r in part])), pack([p["positive_id"] for p in positives]))
                row += (pack([p["positive_score"] for p in positives]), pack([len(r["positives"]) for r in part]))
                number += 1
                yield _table([row], schema)


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """The hardest rows of other labels for each anchor and positive; see the contract of op12.

    Rows without vec_id, label or vector, or with a component that is null or not finite, take no part.
    Vectors of different dimensions have no score with each other. A row is no partner of its own
    vec_id; rows given twice count twice as partners. Of anchors that share a vec_id the one with the
    smallest (label, vector) stands for all. Other columns are ignored; no rows give no rows. Scores
    that do not fit into 64 bits are told by the nearest number that does.
    """
    rows = _usable(embeddings)
    slices = stage(rows.mapInArrow(_packer(SLICES, SLICE, True), SLICES), "slices", "none")
    anchors = rows.filter(F.col("vec_id") % EVERY == 0).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("a"))
    anchors = anchors.select("vec_id", "a.label", "a.vector")
    blocks = stage(anchors.mapInArrow(_packer(ANCHORS, BLOCK, False), ANCHORS), "anchors")

    nearest = stage(_visited(slices, blocks, _positives, POSITIVE), "positives")
    nearest = _first(nearest, ["anchor_id"], "positive_score", "positive_id", POSITIVES)
    entry = F.struct("rank", "positive_id", "positive_score")
    known = nearest.groupBy("anchor_id").agg(
        F.first("dim").alias("dim"), F.first("label").alias("label"), F.first("vector").alias("vector"), F.sort_array(F.collect_list(entry)).alias("positives")
    )  # POSITIVES entries in a list at most
    wanted = stage(known.mapInArrow(_wanted, WANTED), "wanted")

    found = stage(_visited(slices, wanted, _negatives, NEGATIVE), "negatives")
    best = _first(found, ["anchor_id", "place"], "negative_score", "negative_id", NEGATIVES)
    return best.select("anchor_id", "positive_id", F.col("rank").cast(T.IntegerType()), "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all anchors against all embeddings."""
    return hard_negatives(table(spark, sf_dir, "embeddings"))
