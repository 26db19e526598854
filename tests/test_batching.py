"""Calendar batches: labels, order, minimum size, undated rows."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from batchwarden.functions.periods import period_label, period_start
from batchwarden.operators import batching
from batchwarden.profile import TableProfile

PROFILE = TableProfile(name="t", date_column="d", required=("d",), min_batch_rows=2)


def _labels(spark, dates, freq):
    df = spark.createDataFrame([(d,) for d in dates], "d timestamp")
    start = period_start(F.col("d"), freq)
    return [r["l"] for r in df.select(period_label(start, freq).alias("l")).collect()]


@pytest.mark.parametrize(
    "freq,label",
    [("W", "2020-W53"), ("D", "2021-01-01"), ("M", "2021-01"), ("Q", "2021Q1"), ("Y", "2021")],
)
def test_labels_of_new_year_2021(spark, freq, label):
    assert _labels(spark, [datetime(2021, 1, 1)], freq) == [label]


def test_iso_year_can_run_ahead(spark):
    assert _labels(spark, [datetime(2024, 12, 30)], "W") == ["2025-W01"]


@pytest.mark.parametrize("freq", ["W", "W-SUN", "W-MON", "W-WED", "W-SAT", "M", "Q", "Y", "D"])
def test_period_starts_match_pandas(spark, freq):
    dates = [datetime(2023, 12, 25, 7) + pd.Timedelta(days=i) for i in range(20)]
    df = spark.createDataFrame([(d,) for d in dates], "d timestamp")
    found = [r["s"] for r in df.select(period_start(F.col("d"), freq).alias("s")).collect()]
    assert found == [pd.Timestamp(d).to_period(freq).start_time for d in dates]


def test_unknown_frequency_is_refused():
    with pytest.raises(ValueError):
        period_start(None, "H")
    with pytest.raises(ValueError):
        period_start(None, "W-XYZ")


def test_small_batches_and_undated_rows_are_left_out(spark):
    texts = ["2024-01-01", "2024-01-07", "2024-01-08", None, "soon", "2024-01-15", "2024-01-16"]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    batched = batching.assign_batches(df, PROFILE)
    kept = batching.drop_small_batches(batched, 2)
    assert sorted(r["_batch"] for r in kept.collect()) == ["2024-W01"] * 2 + ["2024-W03"] * 2
    assert batching.undated_rows(df, PROFILE).first().asDict() == {"n_undated": 2, "n_rows": 7}
    counts = batching.batch_counts(batched, 2).orderBy("position").collect()
    assert [(r["_batch"], r["n_rows"], r["kept"]) for r in counts] == [
        ("2024-W01", 2, True),
        ("2024-W02", 1, False),
        ("2024-W03", 2, True),
    ]


def test_order_follows_the_calendar_not_the_label(spark):
    dates = [datetime(9999, 1, 1), datetime(2024, 1, 1)]
    df = spark.createDataFrame([(d,) for d in dates], "d timestamp")
    counts = batching.batch_counts(batching.assign_batches(df, PROFILE.but(freq="Y")), 1)
    assert [r["_batch"] for r in counts.orderBy("position").collect()] == ["2024", "9999"]


def test_single_batch_keeps_everything(spark):
    df = spark.createDataFrame([(None,), (datetime(2024, 1, 1),)], "d timestamp")
    rows = batching.single_batch(df).collect()
    assert [r["_batch"] for r in rows] == ["all", "all"]
