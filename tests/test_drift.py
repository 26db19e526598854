"""Drift signals against pandas and hand values."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from batchwarden.operators import drift
from batchwarden.profile import DriftSettings, TableProfile
from batchwarden.sources.staging import stage

SETTINGS = DriftSettings(
    psi_columns=("x",), category_columns=("c",), reference_date="2024-03-01"
)
PROFILE = TableProfile(name="t", date_column="d", required=(), drift=SETTINGS)
START = datetime(2024, 1, 1)
DDL = "x double, c string, d timestamp, _batch string, _period_start timestamp"


def _clean(spark, batches, extra=()):
    """Rows of numbered weekly batches: (x values, c values) each; ``extra`` batches are empty."""
    rows, passing = [], []
    for i, (xs, cs) in enumerate(batches):
        start = START + timedelta(days=7 * i)
        passing.append((f"B{i}", start))
        for x, c in zip(xs, cs):
            rows.append((None if x is None else float(x), c, start, f"B{i}", start))
    for i in extra:
        passing.append((f"E{i}", START + timedelta(days=7 * i)))
    staged = stage(spark.createDataFrame(passing, "_batch string, _period_start timestamp"), "p")
    return spark.createDataFrame(rows, DDL), staged


def _psi(expected, actual, bins=10):
    expected, actual = np.asarray(expected, float), np.asarray(actual, float)
    expected, actual = expected[~np.isnan(expected)], actual[~np.isnan(actual)]
    if not len(expected) or not len(actual):
        return 0.0
    edges = sorted(set(np.quantile(expected, np.arange(bins + 1) / bins)))
    if len(edges) < 2:
        return 0.0
    place = lambda v: np.bincount(np.searchsorted(edges[1:-1], v, side="right"), minlength=len(edges) - 1)
    e, a = (place(v) / len(v) + 1e-6 for v in (expected, actual))
    return float(((a - e) * np.log(a / e)).sum())


def _psi_values(spark, series):
    clean, passing = _clean(spark, [(xs, ["c"] * len(xs)) for xs in series])
    out = drift.psi_by_batch(clean, passing, ["x"], 10).orderBy("_period_start")
    return [r["psi_x"] for r in out.collect()]


def test_psi_matches_numpy_on_random_series(spark):
    rng = np.random.default_rng(7)
    series = [
        rng.normal(size=300),
        rng.normal(3, 1, size=250),
        rng.integers(0, 4, size=200).astype(float),
        np.where(rng.random(300) < 0.5, 1.0, rng.normal(size=300)),
        np.where(rng.random(100) < 0.3, np.nan, rng.exponential(size=100)),
    ]
    lists = [[None if np.isnan(v) else float(v) for v in s] for s in series]
    found = _psi_values(spark, lists)
    assert found[0] is None
    wanted = [_psi(a, b) for a, b in zip(series, series[1:])]
    assert np.allclose(found[1:], wanted, rtol=0, atol=1e-12)
    assert found[1] > 0.2


def test_psi_anchors(spark):
    xs = [float(i) for i in range(100)]
    same = _psi_values(spark, [xs, xs])
    assert same[1] < 1e-6
    assert _psi_values(spark, [[5.0, 5.0, 5.0], [1.0, 2.0, 3.0]])[1] == 0.0
    assert _psi_values(spark, [[None, None], [1.0, 2.0]])[1] == 0.0
    assert _psi_values(spark, [[1.0, 2.0], [None]])[1] == 0.0


def test_psi_below_a_tied_minimum(spark):
    expected = [1.0] * 60 + [float(v) for v in range(2, 42)]
    actual = [0.0] * 10 + [1.0] * 50 + [float(v) for v in range(2, 42)]
    assert _psi_values(spark, [expected, actual])[1] == pytest.approx(_psi(expected, actual), abs=1e-12)


def test_category_shift_and_null_rates(spark):
    """Eight rows per batch: a share moves by one and by two eighths, and nulls come and go."""
    batches = [
        ([2.0] * 8, list("pppppqqr")),
        ([2.0] * 5 + [None] * 3, list("ppppqqqr")),
        ([None] + [2.0] * 7, list("ppqqqsss")),
    ]
    clean, passing = _clean(spark, batches)
    statistics = stage(drift.batch_statistics(clean, passing, PROFILE), "s")
    shift = drift.category_shift_by_batch(clean, statistics, ["c", "absent"])
    assert [r["shift_c"] for r in shift.orderBy("_batch").collect()] == [None, 0.125, 0.375]
    delta = drift.null_rate_deltas(statistics.df, ["x"]).orderBy("_batch").collect()
    assert [r["delta_x"] for r in delta] == [None, 0.375, -0.25]


def test_category_shift_matches_pandas(spark):
    rng = np.random.default_rng(3)
    batches = []
    for _ in range(4):
        cs = [None if v == 0 else f"k{v}" for v in rng.integers(0, 9, size=80)]
        batches.append(([1.0] * 80, cs))
    clean, passing = _clean(spark, batches)
    statistics = stage(drift.batch_statistics(clean, passing, PROFILE), "s")
    out = drift.category_shift_by_batch(clean, statistics, ["c"]).orderBy("_period_start").collect()
    shares = [pd.Series(cs).value_counts(normalize=True) for _, cs in batches]
    for i in range(1, 4):
        change = shares[i].subtract(shares[i - 1], fill_value=0).abs().max()
        assert out[i]["shift_c"] == pytest.approx(change, abs=1e-15)


@pytest.mark.parametrize(
    "newest,days",
    [
        (datetime(2024, 2, 28, 12), 1.0),
        (datetime(2024, 3, 1, 0, 0, 1), -1.0),
        (datetime(2024, 3, 1), 0.0),
        (None, 0.0),
    ],
)
def test_freshness_is_floored(spark, newest, days):
    df = spark.createDataFrame([(newest,)], "d timestamp")
    assert df.select(drift.freshness(F.col("d"), PROFILE).alias("f")).first()["f"] == days
    none = PROFILE.but(drift=replace(SETTINGS, reference_date=None))
    assert df.select(drift.freshness(F.col("d"), none).alias("f")).first()["f"] == 0.0


def test_alerts_and_first_batch(spark):
    low, high = list(range(100)), list(range(500, 600))
    half = [None if i % 2 else v for i, v in enumerate(high)]
    clean, passing = _clean(spark, [(low, ["a"] * 100), (half, ["b"] * 100)])
    out = drift.compute_drift(clean, passing, PROFILE).orderBy("_period_start").collect()
    assert out[0]["drift"] is None and out[0]["_previous"] is None
    record = out[1]["drift"]
    assert record["alerts"] == [
        f"PSI drift on x: {record['psi']['x']:.3f} > 0.2",
        "null-rate drift on x: +0.500",
        "category shift on c: 1.000 > 0.15",
        "stale data: newest d 53d old > 30d",
    ]
    assert out[1]["col_stats"]["x"]["null_rate"] == 0.5
    flags = drift.compute_drift(clean, passing, PROFILE)
    flags = flags.orderBy("_period_start").select(drift.has_alert(F.col("drift")).alias("a"))
    assert [r["a"] for r in flags.collect()] == [False, True]


def test_identical_fresh_batches_raise_nothing(spark):
    settings = replace(SETTINGS, reference_date="2024-01-10")
    xs, cs = list(range(50)), ["a", "b"] * 25
    clean, passing = _clean(spark, [(xs, cs), (xs, cs)])
    out = drift.compute_drift(clean, passing, PROFILE.but(drift=settings))
    assert out.orderBy("_period_start").collect()[1]["drift"]["alerts"] == []


def test_an_empty_passing_batch_is_still_the_previous_one(spark):
    clean, passing = _clean(spark, [([1, 2, 3], ["a", "a", "b"])], extra=[-1, 1])
    out = drift.compute_drift(clean, passing, PROFILE).orderBy("_period_start").collect()
    assert [r["_batch"] for r in out] == ["E-1", "B0", "E1"]
    assert out[1]["drift"]["psi"]["x"] == 0.0
    assert out[1]["drift"]["category_shift"]["c"] == pytest.approx(2 / 3)
    assert out[2]["drift"]["null_rate_delta"]["x"] == 0.0


def test_shock_trips_once(spark):
    from conftest import TESTDATA

    from batchwarden.plans.catalog import QUERIES

    rows = QUERIES["psi_price_shock"](spark, TESTDATA).orderBy("_batch").collect()
    assert [r["_batch"] for r in rows if (r["psi_price"] or 0) > 0.2] == ["1998Q3"]
