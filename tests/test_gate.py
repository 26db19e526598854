"""Halt or quarantine: the gate acts on exactly the rows the checks named."""

from __future__ import annotations

from conftest import whole_report
from pyspark.sql import functions as F

from batchwarden.operators import gate
from batchwarden.operators.batching import assign_batches
from batchwarden.operators.checks import BatchReport
from batchwarden.profiles import VEHICLES

SMALL = VEHICLES.but(min_rows=1, min_batch_rows=1)


def _verdict(df, profile):
    report = whole_report(df, profile)
    return report, gate.gate_verdicts(report).first()


def test_over_ceiling_halts(spark):
    bad = F.when(F.col("id") < 160, -1.0).otherwise(5000.0)
    df = spark.range(400).select(
        bad.alias("price"),
        F.lit("b").alias("brand"),
        F.lit("m").alias("model"),
        F.lit(2000).alias("year"),
        F.lit(1.0).alias("mileage"),
        F.concat(F.lit("V"), "id").alias("vin"),
    )
    _, v = _verdict(df, VEHICLES)
    assert v["halted"] and not v["fatal"] and v["n_quarantined"] == 0
    assert v["reason"] == "ERROR-row fraction 40.0% > ceiling 25%"
    _, at = _verdict(df, VEHICLES.but(max_error_fraction=0.4))
    assert not at["halted"] and at["n_quarantined"] == 160


def test_fatal_checks_halt(clean_df):
    _, short = _verdict(clean_df, VEHICLES)
    assert short["fatal"] and short["halted"]
    assert short["reason"].startswith("batch-fatal")
    _, missing = _verdict(clean_df.drop("price"), SMALL)
    assert missing["fatal"] and missing["halted"]


def test_error_rows_are_a_distinct_union(dirty_df):
    report, v = _verdict(dirty_df, SMALL.but(max_error_fraction=1.0))
    assert v["n_error_rows"] == 6 and not v["halted"]
    assert v["n_error_checks"] == 3 and v["dq_pass_rate"] == 4 / 8
    clean, held = gate.split_clean_quarantine(report.flagged, gate.staged_verdicts(report))
    assert [r["model"] for r in clean.collect()] == ["seat-1"]
    assert {r["model"]: r["_flags"] for r in held.collect()} == {
        "skoda-0": ["duplicates"],
        "dacia-2": ["schema", "ranges"],
        "skoda-3": ["duplicates"],
        "seat-4": ["schema", "ranges"],
        "dacia-5": ["duplicates"],
        "skoda-6": ["schema", "nulls"],
    }


def test_warnings_pass_the_gate(clean_df):
    odd = clean_df.withColumn("title_status", F.lit("scrapped"))
    report, v = _verdict(odd, SMALL)
    assert v["n_error_checks"] == 0 and v["n_error_rows"] == 0 and v["dq_pass_rate"] == 7 / 8
    clean, held = gate.split_clean_quarantine(report.flagged, gate.staged_verdicts(report))
    assert clean.count() == 7 and held.isEmpty()
    assert not {c for c in clean.columns if c in ("_flags", "_is_error", "_disposition")}


def test_a_halted_batch_leaves_the_others_alone(spark):
    rows = [("2024-01-01", -1.0, "A1"), ("2024-01-02", -1.0, "A2")]
    rows += [("2024-01-08", 5.0, "B1"), ("2024-01-09", 5.0, "B2"), ("2024-01-10", -5.0, "B3")]
    df = spark.createDataFrame(rows, "posting_date string, price double, vin string")
    profile = SMALL.but(required=("price",), schema=(), max_error_fraction=0.5)
    report = BatchReport(assign_batches(df, profile), profile)
    verdicts = gate.staged_verdicts(report)
    assert gate.any_halted(verdicts.df)
    clean, held = gate.split_clean_quarantine(report.flagged, verdicts)
    assert {r["vin"] for r in clean.collect()} == {"B1", "B2"}
    assert {r["vin"] for r in held.collect()} == {"B3"}
    rate = gate.catch_rate(verdicts.df).first()
    assert (rate["n_quarantined"], rate["n_rows"], rate["catch_rate"]) == (1, 5, 0.2)


def test_catch_rate_of_no_runs(spark):
    empty = spark.createDataFrame([], "n_quarantined bigint, n_rows bigint")
    assert gate.catch_rate(empty).first()["catch_rate"] == 0.0
