"""Scores of texts under a bigram model smoothed by deleted interpolation.

The probability of a token after its context mixes the bigram and unigram maximum-likelihood estimates
and a uniform share. The weights depend on how frequent the context is, by powers of two, and are
learned by expectation-maximisation on the training documents alone: each of their tokens is predicted
from counts without its own occurrence. Held-out documents are scored and teach nothing.

Documents are gathered into blocks of bounded size, which keep their tokens as indexes into their own
vocabulary. Each block asks for the count of every different unigram and bigram it holds, once: the
requests, with the block's own counts, are dealt by ranges of the n-grams' 64-bit hashes, added up,
and answered in the order of the request. So a word that fills a third of the corpus is one entry per
block, no count table is ever sent whole to anyone, and what is shuffled grows with the corpus.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from batchwarden.llm.common import stage, table

FOLDS, HELD = 7, 2
BLOCK_TOKENS = 1 << 20
# N-grams are dealt into ranges of about this many tokens' worth, and into LEAST ranges at least.
RANGE_TOKENS = 1 << 19
LEAST = 64
BUCKETS = 64  # contexts by the bit length of their count
# The learning step sees probabilities on a grid of this many steps per power of two.
GRID, LOWEST = 4, -64
ROUNDS = 60
END = b""  # no word is empty; also the context of a first word
UNIGRAM = np.uint64(0x9E3779B97F4A7C15)

BLOCK = "block string, held boolean, doc_ids array<bigint>, lengths array<bigint>, n_tokens bigint, vocabulary binary, tokens binary"
BLOCK_ARROW = pa.schema(
    {"block": pa.string(), "held": pa.bool_(), "doc_ids": pa.list_(pa.int64()), "lengths": pa.list_(pa.int64())}
    | {"n_tokens": pa.int64(), "vocabulary": pa.binary(), "tokens": pa.binary()}
)
REQUEST = "kind int, range bigint, block string, keys binary, counts binary"
REQUEST_ARROW = pa.schema({"kind": pa.int32(), "range": pa.int64(), "block": pa.string(), "keys": pa.binary(), "counts": pa.binary()})
ANSWER = "kind int, range bigint, block string, counts binary, n_distinct bigint"
ANSWER_ARROW = pa.schema({"kind": pa.int32(), "range": pa.int64(), "block": pa.string(), "counts": pa.binary(), "n_distinct": pa.int64()})
SCORE = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def held_out(doc_id: int | None) -> bool:
    """Whether a document is left out of the counts; one without doc_id never is."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An even 64-bit hash of two."""
    x = a * np.uint64(0xBF58476D1CE4E5B9) + (b ^ (b >> np.uint64(31)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _planes(numbers: np.ndarray) -> bytes:
    """Unsigned integers as compressed planes of bytes, low ones first, as many as the largest needs."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    split = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + zlib.compress(split.T.tobytes(), 1)


def _from_planes(data: bytes) -> np.ndarray:
    split = np.frombuffer(zlib.decompress(memoryview(data)[1:]), np.uint8).reshape(data[0], -1)
    whole = np.zeros((split.shape[1], 8), np.uint8)
    whole[:, : data[0]] = split.T
    return whole.reshape(-1).view("<u8")


class _Gathering:
    """Documents on their way into a block."""

    def __init__(self) -> None:
        self.words: defaultdict[bytes, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.words[END]  # index 0
        self.doc_ids: list[int | None] = []
        self.tokens: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        words = (text or "").encode("utf-8", "replace").lower().split()
        tokens = np.zeros(len(words) + 1, np.uint32)
        tokens[:-1] = np.fromiter(map(self.words.__getitem__, words), np.uint32, len(words))
        self.doc_ids.append(doc_id)
        self.tokens.append(tokens)
        self.size += len(tokens)

    def row(self, name: str, held: bool) -> pa.RecordBatch:
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        row = {"block": name, "held": held, "doc_ids": self.doc_ids, "lengths": [len(t) for t in self.tokens], "n_tokens": self.size}
        row |= {"vocabulary": hashes.tobytes(), "tokens": _planes(np.concatenate(self.tokens))}
        return pa.RecordBatch.from_pylist([row], schema=BLOCK_ARROW)


def blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = BLOCK_TOKENS) -> DataFrame:
    """Documents as blocks of about ``size`` tokens, training and held-out ones apart. Staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        open_blocks = {False: _Gathering(), True: _Gathering()}
        for batch in batches:
            for one, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                held = held_out(one)
                open_blocks[held].add(one, body.as_py())
                if open_blocks[held].size >= size:
                    yield open_blocks[held].row(f"{task}-{number}", held)
                    number += 1
                    open_blocks[held] = _Gathering()
        for held, block in open_blocks.items():
            if block.doc_ids:
                yield block.row(f"{task}-{number}", held)
                number += 1

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return stage(rows.mapInArrow(run, BLOCK), "blocks")


class _Ngrams:
    """The different unigrams and bigrams of a block, in the order of their hashes."""

    def __init__(self, row: dict) -> None:
        vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
        self.tokens = _from_planes(row["tokens"]).astype(np.uint32)
        # Before the first word of a document stands the end of another, which has index 0.
        self.contexts = np.concatenate((np.zeros(1, np.uint32), self.tokens[:-1]))
        pairs = self.contexts.astype(np.uint64) * np.uint64(len(vocabulary)) + self.tokens
        different, which = np.unique(pairs, return_inverse=True)
        context, word = np.divmod(different, np.uint64(len(vocabulary)))
        bigrams = _mix(vocabulary[context.astype(np.int64)], vocabulary[word.astype(np.int64)])
        unigrams = _mix(np.full(len(vocabulary), UNIGRAM), vocabulary)
        self.of_kind = {1: (unigrams, self.tokens.astype(np.int64)), 2: (bigrams, which.reshape(-1))}

    def requests(self, row: dict, ranges: int) -> Iterator[dict]:
        """Sorted hashes and this block's training counts, by range of the hash."""
        for kind, (keys, which) in self.of_kind.items():
            order = np.argsort(keys, kind="stable")
            counts = np.zeros(len(keys), np.uint32) if row["held"] else np.bincount(which, minlength=len(keys)).astype(np.uint32)
            keys, counts = keys[order], counts[order]
            at = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            begins = np.flatnonzero(np.diff(at.astype(np.int64), prepend=-1))
            for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(keys)]):
                yield {"kind": kind, "range": int(at[a]), "block": row["block"], "keys": _packed(keys[a:b]), "counts": _planes(counts[a:b])}

    def counts(self, answers: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Training counts of every token, of its context, and of both together."""
        found = {}
        for kind, (keys, which) in self.of_kind.items():
            own = sorted((a["range"], a["counts"]) for a in answers if a["kind"] == kind)
            in_order = np.concatenate([_from_planes(c) for _, c in own])
            of_key = np.zeros(len(keys), np.uint64)
            of_key[np.argsort(keys, kind="stable")] = in_order
            found[kind] = of_key
        words = found[1].astype(np.float64)
        return words[self.tokens], words[self.contexts], found[2][self.of_kind[2][1]].astype(np.float64)


def _packed(keys: np.ndarray) -> bytes:
    """Sorted hashes as the first one and their differences, in as few bytes each as the largest needs."""
    steps = np.diff(keys)
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    low = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + low.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    width, first = data[0], np.frombuffer(data, "<u8", 1, 1)
    low = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(low), 8), np.uint8)
    steps[:, :width] = low
    return np.cumsum(np.concatenate((first, steps.reshape(-1).view("<u8"))), dtype=np.uint64)


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the requests of one range of one kind after the other; batches are sorted by both."""

    def answers(rows: list[dict]) -> pa.RecordBatch:
        keys = [_unpacked(r["keys"]) for r in rows]
        counts = np.concatenate([_from_planes(r["counts"]) for r in rows])
        different, which = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(which.reshape(-1), counts, len(different)).astype(np.uint64)
        each = np.split(totals[which.reshape(-1)], np.cumsum([len(k) for k in keys])[:-1])
        seen = int((totals > 0).sum())
        made = [
            {"kind": r["kind"], "range": r["range"], "block": r["block"], "counts": _planes(c), "n_distinct": 0 if k else seen}
            for k, (r, c) in enumerate(zip(rows, each))
        ]
        return pa.RecordBatch.from_pylist(made, schema=ANSWER_ARROW)

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["kind"], row["range"]) != (held[0]["kind"], held[0]["range"]):
                yield answers(held)
                held = []
            held.append(row)
    if held:
        yield answers(held)


def _grid(p: np.ndarray) -> np.ndarray:
    """Places of probabilities on the grid; 0 for none."""
    steps = np.rint(np.log2(np.maximum(p, 2.0**LOWEST)) * GRID) - LOWEST * GRID + 1
    return np.where(p > 0, steps, 0).astype(np.int64)


def _ungrid(place: np.ndarray) -> np.ndarray:
    return np.where(place > 0, 2.0 ** ((place - 1) / GRID + LOWEST), 0.0)


def _bucket(contexts: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else the bit length of the count."""
    return np.frexp(contexts)[1]


def _estimates(words: np.ndarray, contexts: np.ndarray, both: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    return both / np.maximum(contexts, 1), words / max(n, 1)


def learn(cells: list[tuple[int, int, int, int]], uniform: float) -> np.ndarray:
    """Weights of bigram, unigram and uniform share per context bucket, by expectation-maximisation.

    ``cells`` are (bucket, bigram place, unigram place, tokens). Buckets without tokens take
    the weights of all together; without any, the three share alike.
    """
    data = np.array(cells, np.int64).reshape(-1, 4)
    bucket, weight = data[:, 0], data[:, 3].astype(float)
    p = np.column_stack((_ungrid(data[:, 1]), _ungrid(data[:, 2]), np.full(len(data), uniform)))

    def fit(own: np.ndarray, start: np.ndarray) -> np.ndarray:
        mix = start
        for _ in range(ROUNDS):
            part = p[own] * mix
            mix = ((part / part.sum(axis=1, keepdims=True)) * weight[own][:, None]).sum(axis=0) / weight[own].sum()
        return mix

    shared = np.full(3, 1 / 3)
    if len(data):
        shared = fit(np.ones(len(data), bool), shared)
    weights = np.tile(shared, (BUCKETS + 1, 1))
    for b in np.unique(bucket):
        weights[b] = fit(bucket == b, np.full(3, 1 / 3))
    # A context that was never seen has no bigram estimate, and every token must stay possible.
    weights[0] = [0.0, *(weights[0][1:] / weights[0][1:].sum())]
    weights = 0.9999 * weights + 0.0001 * np.array([0, 0, 1])
    return weights


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Words are lower-cased in A-Z and one end closes every text; a null or empty text is its end alone.
    Repeated rows count and are scored each. Rows without doc_id belong to the training documents.
    Other columns are not read.
    """
    stored = blocks(docs, doc_id, text)
    n_tokens, n_train = stored.agg(F.sum("n_tokens"), F.sum(F.when(~F.col("held"), F.col("n_tokens")))).first()
    n_train = n_train or 0
    ranges = max(LEAST, -(-(n_tokens or 0) // RANGE_TOKENS))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                yield pa.RecordBatch.from_pylist(list(_Ngrams(row).requests(row, ranges)), schema=REQUEST_ARROW)

    columns = stored.select("block", "held", "vocabulary", "tokens")
    dealt = columns.mapInArrow(ask, REQUEST).repartition("kind", "range").sortWithinPartitions("kind", "range")
    answers = stage(dealt.mapInArrow(_answer, ANSWER), "answers")
    n_distinct = answers.filter("kind = 1").agg(F.sum("n_distinct")).first()[0] or 0
    per_block = answers.groupBy("block").agg(F.collect_list(F.struct("kind", "range", "counts")).alias("answers"))

    def each(body: Callable[[dict, _Ngrams], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    row = batch.slice(k, 1).to_pylist()[0]
                    yield body(row, _Ngrams(row))

        return run

    def tally(row: dict, ngrams: _Ngrams) -> pa.RecordBatch:
        # The token's own occurrence is taken out of all its counts, as if it had not been learned from.
        words, contexts, both = (np.maximum(c - 1, 0) for c in ngrams.counts(row["answers"]))
        bigram, unigram = _estimates(words, contexts, both, n_train - 1)
        cells, n = np.unique((_bucket(contexts).astype(np.int64) << 32) | (_grid(bigram) << 16) | _grid(unigram), return_counts=True)
        columns = (cells >> 32, (cells >> 16) & 0xFFFF, cells & 0xFFFF, n)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["b", "x", "y", "n"])

    train = stored.filter("NOT held").select("block", "held", "vocabulary", "tokens").join(per_block, "block")
    cells = train.mapInArrow(each(tally), "b bigint, x bigint, y bigint, n bigint").groupBy("b", "x", "y").agg(F.sum("n").alias("n"))
    # As many rows as the grid has cells at most, however large the corpus.
    weights = learn(sorted(tuple(r) for r in cells.collect()), 1 / (n_distinct + 1))

    def scored(row: dict, ngrams: _Ngrams) -> pa.RecordBatch:
        words, contexts, both = ngrams.counts(row["answers"])
        bigram, unigram = _estimates(words, contexts, both, n_train)
        mix = weights[_bucket(contexts)]
        model = np.log10(mix[:, 0] * bigram + mix[:, 1] * unigram + mix[:, 2] / (n_distinct + 1))
        base = np.log10((words + 1) / (n_train + n_distinct + 1))
        begins = np.concatenate(([0], np.cumsum(row["lengths"])[:-1])).astype(np.int64)
        sums = [np.add.reduceat(v, begins) for v in ((words > 0).astype(np.int64), base, model)]
        columns = [pa.array(row["doc_ids"], pa.int64()), pa.array([row["held"]] * len(begins)), pa.array(row["lengths"], pa.int64()), *map(pa.array, sums)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    made = stored.join(per_block, "block").mapInArrow(each(scored), SCORE)
    return made.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("bigint").alias("train_tokens"), "base_score", "score")


def op9_language_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return score(table(spark, sf_dir, "documents"))
