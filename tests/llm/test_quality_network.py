"""The byte network: against a loop over every byte, by its slopes, and by held-out accuracy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchwarden.llm import quality_network as net
from batchwarden.llm.common import table

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, score string"
LABELS = "doc_id long, quality int, text string"


def by_loops(network: net.Network, data: bytes) -> float:
    """The probability of one text, place by place."""
    s, w = network.settings, network.weights
    n = max(1, -(-len(data) // s.chunk))
    symbols = [b + 1 for b in data] + [0] * (n * s.chunk + s.width - len(data))
    tops = []
    for c in range(n):
        best = np.zeros(s.filters)
        for place in range(c * s.chunk, (c + 1) * s.chunk, s.stride):
            seen = np.concatenate([w["bytes"][symbols[place + k]] for k in range(s.width)]).astype(np.float64)
            best = np.maximum(best, seen @ w["filters"] + w["filter_bias"])
        tops.append(best)
    combined = np.concatenate([np.max(tops, axis=0), np.mean(tops, axis=0)])
    hidden = np.maximum(combined @ w["mix"] + w["mix_bias"], 0)
    return 1 / (1 + np.exp(-(hidden @ w["out"] + w["out_bias"][0])))


def test_every_byte_is_seen():
    network = net.Network(net.Settings(chunk=32, filters=5, width=6, stride=2, table=3, hidden=4))
    draw = np.random.default_rng(0)
    texts = [draw.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (0, 1, 5, 31, 32, 33, 64, 500, 5000)]
    assert network.score(texts) == pytest.approx([by_loops(network, t) for t in texts], abs=1e-5)


def test_slopes_match_differences():
    settings = net.Settings(chunk=16, filters=4, width=4, stride=2, table=2, hidden=3)
    network = net.Network(settings)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    draw = np.random.default_rng(5)
    texts = [draw.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (9, 40, 70)]
    labels, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss() -> float:
        p = network.score(texts)
        return float(-(weight * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum() / 3)

    slopes = network._slopes([net.chunks(t, settings) for t in texts], labels, weight)
    for name in ("bytes", "filters", "filter_bias", "mix", "mix_bias", "out", "out_bias"):
        flat, got = network.weights[name].reshape(-1), np.asarray(slopes[name]).reshape(-1)
        for i in np.flatnonzero(np.abs(got) > 1e-4)[:8]:
            kept, small = flat[i], 1e-6
            flat[i] = kept + small
            up = loss()
            flat[i] = kept - small
            down = loss()
            flat[i] = kept
            assert (up - down) / (2 * small) == pytest.approx(got[i], rel=1e-2, abs=1e-4)


def test_held_out_accuracy(spark):
    found = net.op13_quality_network(spark, SF)
    truth = table(spark, SF, "labels").select("doc_id", "quality")
    rows = found.join(truth, "doc_id").filter("held_out").select("score", "predicted", "quality").collect()
    right = {q: [r["predicted"] == q for r in rows if r["quality"] == q] for q in (0, 1)}
    assert min(sum(r) / len(r) for r in right.values()) > 0.85
    pairs = [(a["score"] > b["score"]) for a in rows if a["quality"] == 1 for b in rows if b["quality"] == 0]
    assert sum(pairs) / len(pairs) > 0.97


def test_held_out_labels_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"good text {i} " * 5 if i % 2 else f"{i}|{i}|" * 20, "x") for i in range(60)], DOCS)
    labels = [(i, i % 2, "x") for i in range(60)]
    flipped = [(i, 1 - q if net.held_out(i) else q, t) for i, q, t in labels]
    small = net.Settings(rounds=2)
    scores = [
        sorted((r["doc_id"], r["score"]) for r in net.scored(docs, net.fit(docs, spark.createDataFrame(given, LABELS), small)).collect())
        for given in (labels, flipped)
    ]
    assert scores[0] == scores[1]


def test_nulls_repeats_long_texts_and_clashes(spark):
    rows = [(1, None, "a"), (1, "", "b"), (None, "words", "c"), (2, "x" * 300_000, "d"), (2, "x" * 300_000, "d")]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(None, 1, "t"), (2, None, "t"), (3, 1, "t"), (3, 0, "t"), (9, 5, "t")], LABELS)
    found = net.scored(docs, net.fit(docs, labels)).collect()
    assert len(found) == 5 and {r["score"] for r in found} == {0.5}
    assert [r["held_out"] for r in found if r["doc_id"] is None] == [False]


@pytest.mark.parametrize("quality, score", [(1, 1.0), (0, 0.0)])
def test_labels_of_one_class(spark, quality, score):
    docs = spark.createDataFrame([(i, "some text", "") for i in range(6)], DOCS)
    labels = spark.createDataFrame([(i, quality, "") for i in range(6)], LABELS)
    found = net.scored(docs, net.fit(docs, labels)).collect()
    assert all(r["score"] == pytest.approx(score, abs=1e-9) and r["predicted"] == quality for r in found)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert net.scored(docs, net.fit(docs, labels)).select(F.count(F.lit(1))).first()[0] == 0
