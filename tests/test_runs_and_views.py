"""Run history round trips and the views over it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Row
from pyspark.sql import functions as F

from batchwarden.operators import runs, views


LABELS = ["2023-Q2", "2023-Q3", "2023-Q4", "2024-Q1", "2024-Q2"]


def _figures(k: int) -> dict:
    """Every figure of the k-th run follows from k; the first has no drift, the third was not trained."""
    drift = Row(psi={"price": k / 16}, null_rate_delta={}, category_shift={"brand": k / 64}, freshness_days=2.0 * k, alerts=["moved"] * (k - 2))
    return {
        "rate": 1 - k / 8, "held": 11 * k, "days": 90.0 - k, "null": k / 32,
        "mae": None if k == 2 else 400.0 + 25 * k, "drift": drift if k else None,
    }


def _history(spark):
    rows = []
    for k in (3, 0, 4, 2, 1):
        f = _figures(k)
        stats = {c: Row(mean=1.0, null_rate=f["null"] if c == "mileage" else 0.0) for c in ("price", "mileage")}
        day = datetime(2023, 4 + k, 1)
        rows.append(
            (f"run-{k}", day, LABELS[k], day, 600 + k, f["rate"], k, f["days"], f["held"], k == 2, stats,
             f["drift"], f["mae"], f["mae"], 0.5 if f["mae"] else None, 3 * k)
        )
    return spark.createDataFrame(rows, runs.RUN_SCHEMA)


def test_round_trip_and_order(spark, store):
    assert runs.load_runs(store).isEmpty()
    assert runs.latest_run(runs.load_runs(store)).isEmpty()
    runs.save_runs(store, _history(spark).filter("n_error_checks % 2 = 0"))
    runs.save_runs(store, _history(spark).filter("n_error_checks % 2 = 1"))
    loaded = runs.load_runs(store).collect()
    assert [r["batch_label"] for r in loaded] == LABELS
    assert loaded[0]["drift"] is None and loaded[2]["mae"] is None
    assert loaded[4]["col_stats"]["mileage"]["null_rate"] == 0.125
    assert runs.latest_run(runs.load_runs(store)).first()["batch_label"] == LABELS[-1]
    assert runs.previous_run(runs.load_runs(store)).first()["batch_label"] == LABELS[-1]


def test_json_export_round_trips(spark):
    history = _history(spark)
    back = runs.import_json(runs.export_json(history)).orderBy("ts").collect()
    assert back == history.orderBy("ts").collect()


def test_stamps_follow_period_order(spark):
    records = _history(spark).drop("run_id", "ts")
    started = datetime.fromisoformat("2024-05-01T00:00:00+00:00")
    stamped = runs.stamp_runs(records, started).orderBy("ts").collect()
    assert [r["batch_label"] for r in stamped] == LABELS
    assert stamped[1]["run_id"] == "2023-Q3-2024-05-01T00:00:00.000001+00:00"


def test_views(spark):
    history = _history(spark)
    order = lambda df: df.orderBy("batch_label").collect()
    wanted = [_figures(k) for k in range(5)]
    for k, row in enumerate(order(views.quality_frame(history))):
        assert row.asDict() == {
            "batch_label": LABELS[k], "dq_pass_rate": wanted[k]["rate"], "n_error_checks": k,
            "n_quarantined": wanted[k]["held"], "n_rows": 600 + k,
        }
    assert [r["mae"] for r in order(views.model_frame(history))] == [w["mae"] for w in wanted]
    assert [r["freshness_days"] for r in order(views.freshness_frame(history))] == [w["days"] for w in wanted]
    psi = order(views.psi_frame(history, ["price", "absent"]))
    assert [r["price"] for r in psi] == [None, *(k / 16 for k in range(1, 5))] and psi[4]["absent"] is None
    shifts = order(views.category_shift_frame(history, ["brand"]))
    assert [r["brand"] for r in shifts] == [None, *(k / 64 for k in range(1, 5))]
    assert [r["mileage"] for r in order(views.null_rate_frame(history, ["mileage"]))] == [w["null"] for w in wanted]
    head = views.headline(history).first()
    last = wanted[-1]
    assert (head["n_runs"], head["latest_dq_pass_rate"], head["latest_mae"], head["latest_n_quarantined"]) == (
        5, last["rate"], last["mae"], last["held"],
    )


def test_headline_without_runs(spark):
    head = views.headline(_history(spark).limit(0)).first()
    assert head["n_runs"] == 0 and head["latest_mae"] is None


def test_latest_report_and_quarantine_count(spark):
    flagged = spark.createDataFrame(
        [("B1", datetime(2024, 1, 1), True, ["schema"]), ("B2", datetime(2024, 1, 8), True, ["schema", "ranges"]),
         ("B2", datetime(2024, 1, 8), True, ["duplicates"]), ("B2", datetime(2024, 1, 8), False, ["consistency"])],
        "_batch string, _period_start timestamp, _is_error boolean, _flags array<string>",
    )
    assert views.report_quarantine_count(flagged).first()["n_quarantined"] == 2
    assert views.report_quarantine_count(flagged.limit(0)).first()["n_quarantined"] == 0
    counts = {(r["_batch"], r["name"]): r["n_rows"] for r in views.violation_counts(flagged).collect()}
    assert counts[("B2", "ranges")] == 1 and counts[("B1", "schema")] == 1
    results = flagged.select(
        "_batch", "_period_start", F.lit(0).alias("position"), F.lit("schema").alias("name"),
        F.lit(False).alias("passed"), F.lit("ERROR").alias("severity"), F.lit(1).alias("n_violations"),
        F.lit("d").alias("detail"),
    )
    assert views.report_table(results).count() == 3
    assert views.report_table(results.limit(0)).isEmpty()
