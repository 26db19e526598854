"""Hard negatives against all pairs scored in plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchwarden.llm import hard_negatives as hard

DDL = "vec_id long, embedding array<float>, label int"


def all_pairs(rows: list[tuple]) -> list[tuple]:
    """The contract over every pair."""
    usable = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        usable.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    anchors: dict[int, tuple] = {}
    for r in usable:
        if r[0] % 100 == 0:
            anchors[r[0]] = min(anchors.get(r[0], r), r)
    found = []
    for a, label, v in anchors.values():
        scored = [(-sum(x * y for x, y in zip(v, w)), b, k) for b, k, w in usable if b != a and len(w) == len(v)]
        positives = sorted((s, b) for s, b, k in scored if k == label)[:5]
        others = sorted((s, b) for s, b, k in scored if k != label)
        for p, positive in positives:
            near = [(s, b) for s, b in others if -80 * p <= -100 * s <= -100 * p][:5]
            found += [(a, positive, i + 1, b, -p, -s) for i, (s, b) in enumerate(near)]
    return sorted(found)


def _found(spark, rows: list[tuple]) -> list[tuple]:
    df = spark.createDataFrame(rows, DDL).repartition(4).withColumns({"slice": F.lit("clash"), "codes": F.lit(1), "place": F.lit(2)})
    return sorted(tuple(r) for r in hard.hard_negatives(df).collect())


def _near(n: int, dim: int, seed: int) -> list[tuple]:
    draw = np.random.default_rng(seed)
    middles = draw.standard_normal((4, dim))
    return [(i, [float(x) for x in (middles[i % 4] + 0.4 * draw.standard_normal(dim)) / dim**0.5], int(draw.integers(0, 10))) for i in range(n)]


@pytest.mark.parametrize("dim", [3, 64, 100])
def test_all_pairs(spark, monkeypatch, dim):
    monkeypatch.setattr(hard, "SLICE", 128)
    monkeypatch.setattr(hard, "BLOCK", 3)
    rows = _near(900, dim, dim)
    want = all_pairs(rows)
    assert want and _found(spark, rows) == want


def test_rows_without_part_ties_and_repeats(spark):
    draw = random.Random(3)
    rows = [(i, [float(draw.randint(0, 2)) / 8 for _ in range(4)], draw.choice([1, 2, None])) for i in range(400)]
    rows += [(700, None, 1), (500, [1.0, None, 0.0, 0.0], 1), (600, [float("nan")] * 4, 2), (800, [float("inf")] * 4, 2)]
    rows += [(None, [1.0] * 4, 1), (900, [], 1), (901, [], 2), (1000, [0.5, 0.5], 1), (1001, [0.5, 0.5], 2)]
    rows += [(200, [9.0] * 4, 1)]
    assert _found(spark, rows) == all_pairs(rows)


def test_large_components(spark):
    draw = random.Random(4)
    rows = [(i, [float(draw.randint(-9, 9)) * 1e5 for _ in range(5)], i % 3) for i in range(300)]
    assert _found(spark, rows) == all_pairs(rows)


def test_nothing_given(spark):
    assert _found(spark, []) == []
    assert _found(spark, [(100, [1.0], 1)]) == []


def test_intervals_hold_the_score():
    draw = np.random.default_rng(9)
    for dim in (1, 7, 64, 130):
        turn = hard.rotation(dim)
        rows = np.floor(256 * draw.standard_normal((500, dim)))
        codes, aligned, rest = hard.encode(rows, turn)
        anchor = np.floor(256 * draw.standard_normal(dim))
        low, high = hard.intervals(anchor, turn, codes, aligned, rest)
        exact = rows @ anchor
        assert (low <= exact).all() and (exact <= high).all()
        assert (high - low < 2.1 * np.linalg.norm(rows, axis=1) * np.linalg.norm(anchor) + 1).all()
