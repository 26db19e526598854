"""Each check passes on clean rows and fails on its own defect."""

from __future__ import annotations

import json

import pytest
from conftest import result_of, whole_report

from batchwarden.operators import checks
from batchwarden.profile import ColumnRule, ConsistencyRule
from batchwarden.profiles import VEHICLES

SMALL = VEHICLES.but(min_rows=1)


def test_clean_rows_pass_every_check(clean_df):
    report = whole_report(clean_df, SMALL)
    rows = report.results.orderBy("position").collect()
    assert [r["name"] for r in rows] == [
        "columns",
        "schema",
        "min_rows",
        "nulls",
        "ranges",
        "duplicates",
        "category:title_status",
        "consistency",
    ]
    assert all(r["passed"] for r in rows)
    assert report.flagged.filter("size(_flags) > 0").isEmpty()


def test_missing_column(clean_df):
    r = result_of(whole_report(clean_df.drop("price"), SMALL), "columns")
    assert (r["passed"], r["severity"], r["n_violations"]) == (False, "ERROR", 1)
    assert "price" in r["detail"]


def test_min_rows(clean_df):
    r = result_of(whole_report(clean_df, VEHICLES), "min_rows")
    assert (r["passed"], r["n_violations"], r["detail"]) == (False, 1, "7 rows (min 100)")


def test_empty_table_is_reported(clean_df):
    report = whole_report(clean_df.limit(0), VEHICLES)
    assert report.results.count() == 8
    assert not result_of(report, "min_rows")["passed"]
    assert result_of(report, "nulls")["passed"]


def test_ranges_count_rows_once_and_ignore_nulls(spark):
    rows = [(-1.0, 1200, 5.0), (None, 2000, 5.0), (float("nan"), 2000, 2e6), (5.0, 2000, 5.0)]
    df = spark.createDataFrame(rows, "price double, year int, mileage double")
    r = result_of(whole_report(df, SMALL), "ranges")
    assert (r["passed"], r["n_violations"]) == (False, 2)
    assert r["detail"] == (
        "price: 1 outside [1, 1000000]; year: 1 outside [1950, 2027]; "
        "mileage: 1 outside [0, 1000000]"
    )


def test_ranges_skip_absent_columns(clean_df):
    report = whole_report(clean_df, SMALL.but(ranges={"nonexistent": (0, 1)}))
    assert result_of(report, "ranges")["passed"]


@pytest.mark.parametrize("limit,severity", [(0.0, "ERROR"), (0.14, "WARN")])
def test_null_policy_severity(dirty_df, limit, severity):
    r = result_of(whole_report(dirty_df, SMALL.but(null_fraction_max={"brand": limit})), "nulls")
    assert (r["passed"], r["severity"], r["n_violations"]) == (False, severity, 1)


def test_null_threshold_is_strict_and_absent_columns_are_skipped(dirty_df):
    limits = {"brand": 1 / 7, "nonexistent": 0.0}
    assert result_of(whole_report(dirty_df, SMALL.but(null_fraction_max=limits)), "nulls")["passed"]


def test_one_zero_tolerance_column_makes_all_null_rows_errors(spark):
    rows = [(None, "a", "V1"), (1.0, None, "V2"), (2.0, "b", "V3")]
    df = spark.createDataFrame(rows, "price double, brand string, vin string")
    profile = SMALL.but(null_fraction_max={"price": 0.0, "brand": 0.1}, schema=())
    report = whole_report(df, profile)
    r = result_of(report, "nulls")
    assert (r["severity"], r["n_violations"]) == ("ERROR", 2)
    errors = {x["vin"] for x in report.flagged.filter("_is_error").collect()}
    assert errors == {"V1", "V2"}
    warn = whole_report(df, profile.but(null_fraction_max={"brand": 0.1}))
    assert warn.flagged.filter("_is_error").isEmpty()
    assert warn.flagged.filter("array_contains(_flags, 'nulls')").count() == 1


def test_duplicates_flag_every_copy(dirty_df):
    report = whole_report(dirty_df, SMALL)
    r = result_of(report, "duplicates")
    assert (r["passed"], r["n_violations"]) == (False, 3)
    flagged = report.flagged.filter("array_contains(_flags, 'duplicates')").collect()
    assert {x["model"] for x in flagged} == {"skoda-0", "skoda-3", "dacia-5"}


def test_fully_duplicated_rows_without_key_column(spark):
    rows = [(7.5, None), (8.5, "opel"), (7.5, None), (7.5, None), (8.5, "Opel")]
    df = spark.createDataFrame(rows, "price double, brand string")
    r = result_of(whole_report(df, SMALL), "duplicates")
    assert (r["n_violations"], r["detail"]) == (3, "3 fully-duplicated row(s)")


def test_duplicate_severity_is_configured(dirty_df):
    report = whole_report(dirty_df, SMALL.but(key_severity="WARN"))
    assert result_of(report, "duplicates")["severity"] == "WARN"
    assert report.flagged.filter("_is_error and model = 'dacia-5'").isEmpty()


def test_unknown_category_warns_and_is_case_sensitive(spark):
    df = spark.createDataFrame([("rebuilt",), (None,), ("REBUILT",), ("scrapped",), ("lien",), ("",)], "title_status string")
    r = result_of(whole_report(df, SMALL), "category:title_status")
    assert (r["passed"], r["severity"], r["n_violations"]) == (False, "WARN", 3)


def test_absent_columns_are_skipped(clean_df):
    report = whole_report(clean_df.drop("title_status", "mileage"), SMALL)
    assert "skipped" in result_of(report, "category:title_status")["detail"]
    assert "skipped" in result_of(report, "consistency")["detail"]


def test_consistency(spark):
    rows = [("NEW", 750_000.0), ("fair", 750_000.0), ("like new", None), (None, 750_000.0), ("new", 5.0), ("new", 400_000.0)]
    df = spark.createDataFrame(rows, "condition string, mileage double")
    r = result_of(whole_report(df, SMALL), "consistency")
    assert (r["passed"], r["severity"], r["n_violations"]) == (False, "WARN", 2)


def test_schema_counts_failure_cases(spark):
    rows = [(-1.0, None, 1200), (5.0, "b", 2000)]
    df = spark.createDataFrame(rows, "price double, brand string, year int")
    profile = SMALL.but(schema=tuple(r for r in VEHICLES.schema if r.name in df.columns))
    r = result_of(whole_report(df, profile), "schema")
    assert (r["passed"], r["n_violations"]) == (False, 3)


def test_schema_on_text_columns(spark):
    df = spark.createDataFrame([("5",), ("x",), (None,), ("-3",)], "price string")
    profile = SMALL.but(schema=(ColumnRule("price", "double"),))
    assert result_of(whole_report(df, profile), "schema")["n_violations"] == 3


def test_fractional_years_are_cut(spark):
    df = spark.createDataFrame([(2027.9,), (2028.0,), (1949.9,), (1950.0,)], "year double")
    profile = SMALL.but(schema=(ColumnRule("year", "int"),))
    assert result_of(whole_report(df, profile), "schema")["n_violations"] == 2


def test_samples_are_json_and_limited(spark):
    rows = [(-float(i), f"b{i}", f"V{i}") for i in range(1, 9)]
    df = spark.createDataFrame(rows, "price double, brand string, vin string")
    report = whole_report(df, SMALL.but(schema=()))
    samples = checks.check_samples(report.flagged, ("vin",)).orderBy("rank").collect()
    assert [json.loads(s["sample"])["vin"] for s in samples] == ["V1", "V2", "V3", "V4", "V5"]
    assert json.loads(samples[0]["sample"]) == {"price": -1.0, "brand": "b1", "vin": "V1"}


def test_sample_rank_is_limited_before_the_shuffle(dirty_df):
    report = whole_report(dirty_df, SMALL)
    plan = checks.check_samples(report.flagged)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_totals_and_lines(dirty_df):
    profile = SMALL.but(consistency=ConsistencyRule("brand", ("seat",), "mileage", 10_000))
    report = whole_report(dirty_df, profile)
    totals = checks.report_totals(report.results).first()
    assert (totals["n_passed"], totals["n_warn"], totals["n_error_checks"]) == (3, 2, 3)
    assert not totals["passed"]
    lines = {r["name"]: r["line"] for r in checks.summary_lines(report.results).collect()}
    assert lines["columns"] == "[PASS ] columns        all required columns present"
    assert lines["ranges"].startswith("[ERROR] ranges         price: 1 outside")


def test_checks_are_per_batch(spark):
    rows = [("2024-01-01", "V1"), ("2024-01-08", "V1"), ("2024-01-09", "V2"), ("2024-01-10", "V2")]
    df = spark.createDataFrame(rows, "posting_date string, vin string")
    from batchwarden.operators.batching import assign_batches

    profile = SMALL.but(min_batch_rows=1, required=(), schema=())
    report = checks.BatchReport(assign_batches(df, profile), profile)
    found = {r["_batch"]: r["n_violations"] for r in report.results.filter("name = 'duplicates'").collect()}
    assert found == {"2024-W01": 0, "2024-W02": 2}
