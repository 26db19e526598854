"""Token ids in files of canonical, length-limited Huffman codes.

One pass encodes the texts and counts the ids of all documents. The code lengths that are optimal
under a limit (package-merge over at most a vocabulary of counts) make up the whole code book. Blocks
of whole documents are coded independently of each other, and every LANE ids the bit offset is kept
as a checkpoint, so a block is decoded with one table lookup per id in all its lanes at once.

The file format is a Parquet table, written and committed by Spark: one row per block with its
documents, checkpoints and the bit stream (big-endian 32-bit words). Files follow ascending doc_id,
and so do the blocks inside a file. The code book lies beside them.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from batchwarden.llm.common import stage, table
from batchwarden.llm.tokens import map_ids
from batchwarden.session import shared_folder

TOKENIZER = "word_bpe_49k.json"
END = 2
MAX_BITS = 20
LANE = 128
BLOCK_IDS = 1 << 16
SYMBOLS = 1 << 16  # ids are below this; they are staged in 16 bits
COUNTED = 256  # documents whose ids are counted at once

BLOCK = "file int, block int, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint, starts array<bigint>, checkpoints binary, words binary"
BLOCK_ARROW = pa.schema(
    {"file": pa.int32(), "block": pa.int32(), "doc_ids": pa.list_(pa.int64()), "lengths": pa.list_(pa.int64()), "n_ids": pa.int64()}
    | {"starts": pa.list_(pa.int64()), "checkpoints": pa.binary(), "words": pa.binary()}
)


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits per symbol, by package-merge; 0 for unseen symbols."""
    seen = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(seen) < 2:
        lengths[seen] = 1
        return lengths
    if len(seen) > 1 << limit:
        raise ValueError(f"{len(seen)} symbols do not fit codes of {limit} bits")
    order = seen[np.argsort(counts[seen], kind="stable")]
    leaves = counts[order].astype(np.int64)
    merged, is_leaf = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, pairs))
        rank = np.argsort(both, kind="stable")
        merged = both[rank]
        is_leaf.append(rank < len(leaves))
    take = 2 * len(leaves) - 2
    depth = np.zeros(len(leaves), np.uint8)
    for level in reversed(is_leaf):
        n = int(level[:take].sum())
        depth[:n] += 1
        take = 2 * (take - n)
    lengths[order] = depth
    return lengths


@dataclass
class CodeBook:
    """Canonical codes: by length, then by symbol. Built from the lengths alone."""

    lengths: np.ndarray

    def __post_init__(self) -> None:
        symbols = np.flatnonzero(self.lengths)
        symbols = symbols[np.lexsort((symbols, self.lengths[symbols]))]
        bits = self.lengths[symbols].astype(np.int64)
        self.limit = max(1, int(bits.max(initial=1)))
        # A code begins where the shares of the code space that precede it end.
        spans = np.left_shift(1, self.limit - bits)
        first = np.concatenate(([0], np.cumsum(spans)[:-1])) if len(spans) else spans
        self.codes = np.zeros(len(self.lengths), np.uint64)
        self.codes[symbols] = first >> (self.limit - bits)
        filled = np.repeat(symbols << 5 | bits, spans)
        # Entry: symbol and length of the code that the next ``limit`` bits begin with.
        self.table = np.zeros(1 << self.limit, np.uint32)
        self.table[: len(filled)] = filled

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """The bit stream of ids as 32-bit words, and the bit offsets of the lanes as 32-bit integers."""
        bits = self.lengths[ids].astype(np.uint64)
        ends = np.cumsum(bits)
        at = ends - bits
        total = int(ends[-1]) if len(ids) else 0
        wide = self.codes[ids] << (np.uint64(64) - (at & np.uint64(31)) - bits)
        word = (at >> np.uint64(5)).astype(np.int64)
        out = np.zeros((total + 31) // 32 + 1, np.uint64)
        if len(ids):
            begins = np.flatnonzero(np.diff(word, prepend=-1))
            out[word[begins]] += np.add.reduceat(wide >> np.uint64(32), begins)
            out[word[begins] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), begins)
        return at[::LANE].astype("<u4").tobytes(), out.astype(">u4").tobytes()

    def decode(self, n_ids: int, checkpoints: bytes, words: bytes) -> np.ndarray:
        """The ids of a bit stream, one lookup per id in all lanes at once."""
        if not n_ids:
            return np.zeros(0, np.uint32)
        stream = np.frombuffer(words, ">u4").astype(np.uint64)
        pairs = stream << np.uint64(32)
        pairs[:-1] |= stream[1:]
        at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
        out = np.zeros((LANE, len(at)), np.uint32)
        last, shift = len(pairs) - 1, 64 - self.limit
        mask = (1 << self.limit) - 1
        for step in range(min(LANE, n_ids)):
            word = np.minimum(at >> 5, last)
            entry = self.table[(pairs[word] >> (shift - (at & 31)).astype(np.uint64)).astype(np.int64) & mask]
            out[step] = entry >> 5
            at += entry & 31
        return out.T.reshape(-1)[:n_ids]


def count_ids(coded: DataFrame, ids: str = "ids") -> np.ndarray:
    """How often each id occurs, over all rows: counted per partition, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SYMBOLS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, COUNTED):
                joined = b"".join(batch.column(0).slice(at, COUNTED).to_pylist())
                counts += np.bincount(np.frombuffer(joined, "<u2"), minlength=SYMBOLS)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen], pa.int64())], ["id", "n"])

    per_task = coded.select(ids).mapInArrow(run, "id int, n bigint")
    counts = np.zeros(SYMBOLS, np.int64)
    for row in per_task.groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most a vocabulary of rows
        counts[row.id] = row.n
    return counts


def write(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> str:
    """Encode all texts and write code book and blocks; returns the folder.

    A null or empty text is a document of its end id alone. A null doc_id comes first. Repeated rows
    are documents of their own. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/batchwarden-llm/ids-{uuid.uuid4().hex}"

    def row(ids: np.ndarray) -> tuple[bytes]:
        if len(ids) and int(ids.max()) >= SYMBOLS:
            raise ValueError("ids of more than 16 bits")
        return (np.append(ids, END).astype("<u2").tobytes(),)

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    coded = stage(map_ids(rows, TOKENIZER, "ids binary", row), "ids")
    lengths = code_lengths(count_ids(coded))
    book = CodeBook(lengths)
    spark.createDataFrame([(lengths.tobytes(),)], "lengths binary").coalesce(1).write.parquet(f"{folder}/book")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, number, start = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        starts: list[int] = []

        def block() -> pa.RecordBatch:
            nonlocal number
            joined = np.concatenate(ids)
            checkpoints, words = book.encode(joined)
            made = {"file": file, "block": number, "doc_ids": list(names), "lengths": [len(x) for x in ids], "n_ids": len(joined)}
            made |= {"starts": list(starts), "checkpoints": checkpoints, "words": words}
            number += 1
            for kept in (ids, names, starts):
                kept.clear()
            return pa.RecordBatch.from_pylist([made], schema=BLOCK_ARROW)

        held = 0
        for batch in batches:
            for name, value in zip(batch.column(0), batch.column(1)):
                own = np.frombuffer(value.as_py(), "<u2")
                names.append(name.as_py())
                starts.append(start)
                ids.append(own)
                start += len(own)
                held += len(own)
                if held >= BLOCK_IDS:
                    yield block()
                    held = 0
        if names:
            yield block()

    parts = coded.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ordered = coded.repartitionByRange(int(parts), "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(blocks, BLOCK).write.option("compression", "none").parquet(f"{folder}/blocks")
    return folder


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``, ``ids``) per document of a written folder.

    ``start`` counts the ids of all documents before it: those before it in its file, and those of all
    files before. Only totals per file are brought together for that.
    """
    lengths = np.frombuffer(spark.read.parquet(f"{folder}/book").first()[0], np.uint8)
    stored = spark.read.parquet(f"{folder}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = CodeBook(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                ids = book.decode(row["n_ids"], row["checkpoints"], row["words"])
                bounds = np.concatenate(([0], np.cumsum(row["lengths"]))).tolist()
                raw = [ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds, bounds[1:])]
                columns = [[row["file"]] * len(raw), row["doc_ids"], row["starts"], row["lengths"], [zlib.crc32(x) for x in raw], raw]
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ["file", "doc_id", "start", "n_tokens", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows = stored.mapInArrow(run, "file int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
    totals = stored.groupBy("file").agg(F.sum("n_ids").alias("n"))  # one row per file
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    whole = rows.join(F.broadcast(bases), "file")
    return whole.select("doc_id", (F.col("start") + F.col("base")).cast("bigint").alias("start"), "n_tokens", "ids_crc32", "ids")


def op3_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of all documents, written and read back."""
    return read(spark, write(table(spark, sf_dir, "documents"))).drop("ids")
