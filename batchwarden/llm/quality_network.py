"""Text quality by a byte-level convolutional network, in numpy.

A text is cut into chunks of bytes that overlap by the reach of a filter, so that every place of the
whole text is seen. Bytes are looked up in a small table of learned vectors, learned filters run over
them, and each filter keeps its largest answer within a chunk. A document combines the chunks by the
largest and the mean answer of each filter, and a small layer turns both into one probability.

The network learns in one task from a bounded sample of labelled documents (see ``Settings``) and is a
few kilobytes of weights; scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from batchwarden.llm.common import table

FOLDS, HELD = 3, 1
SCORES = "doc_id bigint, held_out boolean, score double, predicted int"


@dataclass(frozen=True)
class Settings:
    """Sizes of the network and bounds of what it learns from."""

    sample: int = 800  # labelled documents per class, chosen by a hash of doc_id
    longest: int = 1 << 14  # bytes; longer labelled documents are left out of the sample, not cut
    rounds: int = 8
    step: float = 0.01
    batch: int = 32
    chunk: int = 1024  # bytes
    filters: int = 24
    width: int = 12  # bytes that a filter sees
    stride: int = 4
    table: int = 8  # numbers per byte
    hidden: int = 16
    seed: int = 7


def held_out(doc_id: int | None) -> bool:
    """Whether a document's label is never learned from; one without doc_id is never held out."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD


def chunks(data: bytes, settings: Settings) -> tuple[np.ndarray, int]:
    """All bytes of a text as overlapping chunks of symbols, and their number; byte values follow the filler 0.

    Chunks begin ``chunk`` bytes apart and run on by what a filter reaches beyond its start, so every
    place where a filter can begin belongs to one chunk. The last one is filled up.
    """
    reach = settings.width - settings.stride
    n = max(1, -(-len(data) // settings.chunk))
    padded = np.zeros(n * settings.chunk + reach, np.int16)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    padded[: len(data)] += 1
    windows = np.lib.stride_tricks.sliding_window_view(padded, settings.chunk + reach)[:: settings.chunk]
    return windows, n


class Network:
    """Weights, the way from bytes to a probability, and back."""

    def __init__(self, settings: Settings) -> None:
        draw = np.random.default_rng(settings.seed)
        self.settings = settings
        fan = settings.width * settings.table

        def drawn(rows: int, columns: int) -> np.ndarray:
            return (draw.standard_normal((rows, columns)) * np.sqrt(2.0 / rows)).astype(np.float32)

        self.weights = {
            "bytes": (0.5 * draw.standard_normal((257, settings.table))).astype(np.float32),
            "filters": drawn(fan, settings.filters),
            "filter_bias": np.zeros(settings.filters, np.float32),
            "mix": drawn(2 * settings.filters, settings.hidden),
            "mix_bias": np.zeros(settings.hidden, np.float32),
            "out": drawn(settings.hidden, 1)[:, 0],
            "out_bias": np.zeros(1, np.float32),
        }
        self.weights["bytes"][0] = 0.0

    def flatten(self, logit: float) -> None:
        """Give every text the same probability."""
        self.weights["out"][:] = 0.0
        self.weights["out_bias"][:] = logit

    def answers(self, symbols: np.ndarray) -> np.ndarray:
        """What every filter says at every place: (chunk, place, filter)."""
        s, w = self.settings, self.weights
        embedded = np.ascontiguousarray(w["bytes"][symbols]).reshape(len(symbols), -1)
        size = s.width * s.table
        views = np.lib.stride_tricks.sliding_window_view(embedded, size, axis=1)[:, :: s.stride * s.table]
        return views @ w["filters"] + w["filter_bias"]

    def pooled(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest answer of each filter in each chunk, at least 0, and the place of it."""
        said = self.answers(symbols)
        at = said.argmax(axis=1)
        top = np.take_along_axis(said, at[:, None], axis=1)[:, 0]
        return np.maximum(top, 0.0), at

    def head(self, combined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden layer and probability of combined documents."""
        w = self.weights
        hidden = np.maximum(combined @ w["mix"] + w["mix_bias"], 0.0)
        logit = hidden @ w["out"] + w["out_bias"][0]
        return hidden, 1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30)))

    def combine(self, tops: np.ndarray, counts: list[int]) -> np.ndarray:
        """Chunks of several documents combined per document."""
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        largest = np.maximum.reduceat(tops, starts, axis=0)
        mean = np.add.reduceat(tops, starts, axis=0) / np.array(counts, np.float32)[:, None]
        return np.concatenate([largest, mean], axis=1)

    def learn(self, texts: list[bytes], labels: np.ndarray) -> None:
        """Adam on the cross entropy, both classes weighing the same."""
        s, w = self.settings, self.weights
        draw = np.random.default_rng(s.seed + 1)
        cut = [chunks(t, s) for t in texts]
        share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
        count = 0
        for turn in range(s.rounds):
            order = draw.permutation(len(texts))
            rate = s.step * (1 - turn / s.rounds)
            for at in range(0, len(order), s.batch):
                rows = order[at : at + s.batch]
                slopes = self._slopes([cut[i] for i in rows], labels[rows], weight[rows])
                count += 1
                for k, slope in slopes.items():
                    first, second = moments[k]
                    first += 0.1 * (slope - first)
                    second += 0.001 * (slope * slope - second)
                    size = np.sqrt(second / (1 - 0.999**count)) + 1e-8
                    w[k] -= (rate * (first / (1 - 0.9**count)) / size).astype(np.float32)
        w["bytes"][0] = 0.0

    def _slopes(self, cut: list, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        s, w = self.settings, self.weights
        symbols, counts = np.concatenate([c for c, _ in cut]), [n for _, n in cut]
        tops, at = self.pooled(symbols)
        combined = self.combine(tops, counts)
        hidden, p = self.head(combined)
        error = ((p - labels) * weight / len(labels)).astype(np.float32)
        slopes = {"out": hidden.T @ error, "out_bias": error.sum(keepdims=True)}
        behind = np.outer(error, w["out"]) * (hidden > 0)
        slopes |= {"mix": combined.T @ behind, "mix_bias": behind.sum(axis=0)}
        back = behind @ w["mix"].T
        of = np.repeat(np.arange(len(counts)), counts)
        largest = combined[:, : s.filters]
        is_top = (tops == largest[of]) & (tops > 0)
        ties = np.maximum(np.add.reduceat(is_top, np.concatenate([[0], np.cumsum(counts)[:-1]]), axis=0), 1)
        slope = is_top * (back[:, : s.filters] / ties)[of]
        slope += (tops > 0) * (back[:, s.filters :] / np.array(counts, np.float32)[:, None])[of]
        chunk, which = np.nonzero(slope)
        places = at[chunk, which] * s.stride
        seen = symbols[chunk[:, None], places[:, None] + np.arange(s.width)]
        inputs = w["bytes"][seen].reshape(len(chunk), -1)
        value = slope[chunk, which]
        by_filter = np.zeros((s.filters, inputs.shape[1]), np.float32)
        np.add.at(by_filter, which, inputs * value[:, None])
        slopes |= {"filters": by_filter.T, "filter_bias": np.bincount(which, value, s.filters).astype(np.float32)}
        to_bytes = (w["filters"].T[which] * value[:, None]).reshape(-1, s.table)
        table_slope = np.zeros_like(w["bytes"])
        np.add.at(table_slope, seen.ravel(), to_bytes)
        table_slope[0] = 0.0
        return slopes | {"bytes": table_slope}

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of good quality per whole text; long texts go through piece by piece."""
        s, tops, counts = self.settings, [], []
        held: list[np.ndarray] = []
        size = 0
        for text in texts:
            symbols, n = chunks(text, s)
            counts.append(n)
            for at in range(0, n, 64):
                held.append(symbols[at : at + 64])
                size += len(held[-1])
                if size >= 64:
                    tops.append(self.pooled(np.concatenate(held))[0])
                    held, size = [], 0
        if held:
            tops.append(self.pooled(np.concatenate(held))[0])
        return self.head(self.combine(np.concatenate(tops), counts))[1]


def _sample(documents: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """Labelled documents to learn from: at most ``sample`` of each class, never a held-out one.

    Labels that contradict each other for one document are left out. The ids are chosen among all
    labels first, by a hash of them; each finds its document by a broadcast of these few ids.
    """
    doc_id = F.col("doc_id").cast("bigint")
    learned = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    learned = learned.filter(F.crc32(doc_id.cast("string")) % FOLDS != HELD)
    agreed = learned.groupBy(doc_id.alias("doc_id")).agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    agreed = agreed.filter("quality = other").select("doc_id", "quality")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # Three times as many ids as needed, as some documents are longer than the bound.
    ids = [agreed.filter(F.col("quality") == q).orderBy(*order).limit(3 * settings.sample) for q in (0, 1)]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = documents.select(doc_id.alias("doc_id"), text.alias("text")).filter(F.octet_length("text") <= settings.longest)
    found = texts.join(F.broadcast(ids[0].unionByName(ids[1])), "doc_id")
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("text")]
    parts = [found.filter(F.col("quality") == q).orderBy(*order).limit(settings.sample) for q in (0, 1)]
    return parts[0].unionByName(parts[1])


def _fit(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["doc_id"], r["text"], r["quality"]) for batch in batches for r in batch.to_pylist())
        network = Network(settings)
        labels = np.array([r[2] for r in rows], np.float32)
        if len(set(labels.tolist())) == 2:
            network.learn([r[1].encode("utf-8", "surrogatepass") for r in rows], labels)
        else:  # nothing to tell apart: the same probability for every text
            network.flatten(30.0 * (2 * labels.mean() - 1) if len(labels) else 0.0)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(network.weights)], pa.binary())], ["weights"])

    return run


def fit(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Network:
    """A network that has learned from a bounded sample of the labelled documents.

    Labels of one class only, or none at all, give one probability for every text: 1, 0 or one half.
    """
    sample = _sample(documents, labels, settings)
    found = sample.coalesce(1).mapInArrow(_fit(settings), "weights binary").first()
    network = Network(settings)
    if found is None:  # no task ran, as there is no row to learn from
        network.flatten(0.0)
    else:
        network.weights = pickle.loads(found["weights"])
    return network


def scored(documents: DataFrame, network: Network) -> DataFrame:
    """Per document its score, (doc_id, held_out, score, predicted); a null text counts as empty.

    Rows without doc_id are scored as well and never held out. Repeated rows have a result each. Other
    columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            if not ids:
                continue
            found = network.score([(t or "").encode("utf-8", "surrogatepass") for t in texts]).astype(np.float64)
            columns = [ids, [held_out(i) for i in ids], found, (found >= 0.5).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCORES)


def op13_quality_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    documents = table(spark, sf_dir, "documents")
    return scored(documents, fit(documents, table(spark, sf_dir, "labels")))
