"""End to end: single batch, backfill, halts, idempotence, strict load, and the registered queries."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from batchwarden.operators import inject
from batchwarden.plans.catalog import QUERIES
from batchwarden.plans.oracles import ORACLES
from batchwarden.plans.pipeline import run_batches, strict_load
from batchwarden.profile import ModelSettings
from batchwarden.profiles import EVENTS, LISTINGS
from batchwarden.sources import testdata
from batchwarden.sources.staging import stage

SMALL = ModelSettings(tree_depth=5, forest_trees=3, forest_depth=4)
YEARLY = LISTINGS.but(freq="Y", models=SMALL)


def _listings(spark):
    return stage(testdata.listings(spark, TESTDATA), "listings").df


def test_single_batch_trains_and_records(spark, store):
    rows = _listings(spark)
    result = run_batches(rows, YEARLY, store, backfill=False)
    runs = result.runs.collect()
    assert len(runs) == 1 and runs[0]["batch_label"] == "all" and not result.halted
    assert runs[0]["n_rows"] == rows.count() and runs[0]["mae"] > 0 and runs[0]["drift"] is None
    assert result.clean.count() + result.quarantine.count() == rows.count()
    assert result.quarantine.count() == runs[0]["n_quarantined"] > 0
    assert result.metrics.count() == 4
    assert store.read("model_verdicts").first()["beats_baseline"]


def test_backfill_trains_every_passing_batch(spark, store):
    result = run_batches(_listings(spark), YEARLY, store)
    runs = result.runs.orderBy("ts").collect()
    assert len(runs) >= 3 and [r["batch_label"] for r in runs] == sorted(r["batch_label"] for r in runs)
    assert all(r["mae"] is not None for r in runs)
    assert runs[0]["drift"] is None and all(r["drift"]["psi"] for r in runs[1:])
    assert result.check_results.count() == 8 * len(runs)


def test_quarantine_is_exactly_the_injected_rows(spark, store):
    rows = testdata.listings(spark, TESTDATA).filter("price >= 1").dropDuplicates(["vin"])
    hit = inject.inject_defects(rows, F.col("vin_strict"), 0.06, "1995-01-01")
    hit = stage(hit, "hit").df
    errors = {
        r["vin_strict"]
        for r in hit.filter("_defect IN ('nonpositive_price', 'impossible_year', 'duplicate_vin', 'null_brand')").collect()
    }
    profile = LISTINGS.but(null_fraction_max={"price": 0.0, "brand": 0.0})
    result = run_batches(hit.drop("_defect"), profile, store, backfill=False, train=False)
    assert {r["vin_strict"] for r in result.quarantine.collect()} == errors
    assert result.clean.filter("price <= 0 OR brand IS NULL OR vin = 'DUPLICATE-VIN'").isEmpty()


def test_everything_halted_leaves_only_the_record(spark, store):
    rows = _listings(spark)
    result = run_batches(rows.drop("price"), YEARLY, store, backfill=False)
    assert result.halted and result.clean.isEmpty() and result.quarantine.isEmpty()
    row = result.runs.first()
    assert row["mae"] is None and row["freshness_days"] == 0.0 and row["n_quarantined"] == 0
    tiny = run_batches(rows.limit(50), YEARLY, store, backfill=False)
    assert tiny.halted and tiny.clean.isEmpty() and tiny.runs.first()["mae"] is None


def test_a_repeated_run_changes_nothing(spark, store):
    rows = _listings(spark)
    once = run_batches(rows, YEARLY, store, train=False)
    first = (once.clean.count(), once.quarantine.count(), once.runs.count())
    again = run_batches(rows, YEARLY, store, train=False)
    assert (again.clean.count(), again.quarantine.count(), again.runs.count()) == first


def test_strict_load_refuses_or_replaces(spark, store):
    rows = testdata.events(spark, TESTDATA)
    assert strict_load(rows, EVENTS, store, "t") is None and not store.exists("t")
    wide = EVENTS.but(ranges={"value": (0, 10**9)})
    assert strict_load(rows, wide, store, "t") == 1000
    assert strict_load(rows, wide, store, "t") == 1000
    assert store.read("t").count() == 1000


def test_store_modes_and_sql(spark, store):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, x int")
    assert store.write(df, "t") == 2 and store.write(df, "t", "append") == 2
    assert store.query("t").count() == 4
    assert store.query("SELECT sum(x) AS s FROM t", ("t",)).first()["s"] == 6
    store.write(df, "r", "refresh", ("p",))
    store.write(df.filter("p = 'a'").withColumn("x", F.lit(9)), "r", "refresh", ("p",))
    assert {(r["p"], r["x"]) for r in store.read("r").collect()} == {("a", 9), ("b", 2)}
    with pytest.raises(ValueError):
        store.write(df, "t", "upsert")


def test_clean_reads_prune_other_partitions(spark, store):
    result = run_batches(_listings(spark), YEARLY, store, train=False)
    one = result.clean.filter("_batch = '1996'").select("price")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "ReadSchema: struct<price:double>" in plan
    assert "PartitionFilters: []" not in plan


def test_entry_contract(spark):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert {r["_batch"] for r in rows} == {"2024-W01", "2024-W02", "2024-W03", "2024-W04"}
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == {"model_comparison", "view_models"}


def test_columns_of_the_data_are_all_kept(spark, store):
    rows = _listings(spark).withColumns({"_id": F.lit(1), "over_price": F.lit("x"), "n_rows": F.lit(2)})
    result = run_batches(rows, YEARLY, store, train=False)
    assert set(rows.columns) <= set(result.clean.columns)
    assert result.clean.filter("_id = 1 AND over_price = 'x' AND n_rows = 2").count() == result.clean.count()


def test_rows_are_judged_once(dirty_df, store, monkeypatch):
    """Summary, stored rows and samples of a run read one table of judged rows."""
    from batchwarden.operators import duplicates
    from batchwarden.plans import pipeline
    from batchwarden.profiles import VEHICLES

    read = []
    plain = pipeline.dispose

    def seen(flagged, verdicts):
        read.extend(flagged.inputFiles())
        return plain(flagged, verdicts)

    monkeypatch.setattr(pipeline, "dispose", seen)
    result = pipeline.run_batches(dirty_df, VEHICLES, store, backfill=False, train=False)
    assert read and all("/judged-" in name for name in read)
    assert result.runs.count() == 1
    assert not {duplicates.REPEATED_KEY, "_schema"} & set(result.clean.columns)
