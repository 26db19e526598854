"""Injected faults, and the checks that catch them."""

from __future__ import annotations

from conftest import TESTDATA
from pyspark.sql import functions as F

from batchwarden.operators import checks, inject
from batchwarden.operators.batching import single_batch
from batchwarden.profiles import LISTINGS
from batchwarden.sources import testdata
from batchwarden.sources.staging import stage

KEY = F.concat_ws


def _hit(spark, share, seed=42):
    rows = testdata.listings(spark, TESTDATA).filter("price >= 1").dropDuplicates(["vin"])
    key = F.concat_ws("|", "vin", "model")
    return stage(inject.inject_defects(rows, key, share, "1995-01-01", seed), "hit").df


def test_defects_are_recorded_and_caught_exactly(spark):
    df = _hit(spark, 0.06)
    n = {r["_defect"]: r["n_rows"] for r in inject.defect_counts(df).collect()}
    assert set(n) == set(inject.DEFECTS)
    assert abs(sum(n.values()) / df.count() - 0.06) < 0.012
    profile = LISTINGS.but(null_fraction_max={"brand": 0.0})
    report = checks.BatchReport(single_batch(df), profile, whole=True)
    found = {r["name"]: r["n_violations"] for r in report.results.collect()}
    assert found["ranges"] == n["nonpositive_price"] + n["impossible_year"]
    assert found["duplicates"] == n["duplicate_vin"]
    assert found["nulls"] == n["null_brand"]
    assert found["schema"] == n["null_brand"] + n["nonpositive_price"] + n["impossible_year"]
    values = df.filter("_defect = 'nonpositive_price'").select("price").toPandas()["price"]
    assert (values <= 0).all() and (values == 0).any() and (values < 0).any()


def test_nothing_is_hit_without_a_share(spark):
    df = _hit(spark, 0.0)
    assert df.filter("_defect IS NOT NULL").isEmpty()


def test_hits_do_not_depend_on_partitioning_but_on_the_seed(spark):
    base = testdata.listings(spark, TESTDATA)
    hits = []
    for rows, seed in ((base, 1), (base.repartition(7), 1), (base, 2)):
        df = inject.inject_defects(rows, F.col("vin_strict"), 0.1, "1995-01-01", seed)
        hits.append({(r["vin_strict"], r["_defect"]) for r in df.filter("_defect IS NOT NULL").collect()})
    assert hits[0] == hits[1] and hits[0] != hits[2]


def test_drift_over_periods(spark):
    weeks = spark.range(4000).select(
        F.concat(F.lit("k"), "id").alias("k"),
        F.lit(100.0).alias("price"),
        F.lit(1.0).alias("mileage"),
        F.lit("old").alias("brand"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval((F.col("id") % 4 * 7).cast("int"))).alias("posting_date"),
    )
    spec = inject.DriftSpec(
        inflation=0.1, shock_period=2, shock_multiplier=1.5, rising_null_column="mileage",
        null_step=0.3, new_category_period=3,
    )
    out = inject.inject_drift(weeks, F.col("k"), spec, "W", "2024-01-03")
    got = out.groupBy("posting_date").agg(
        F.avg("price").alias("p"), F.avg(F.col("mileage").isNull().cast("int")).alias("m"),
        F.avg((F.col("brand") == "new-brand").cast("int")).alias("b"),
    ).orderBy("posting_date").collect()
    for k, r in enumerate(got):
        assert abs(r["p"] - 100 * 1.1**k * (1.5 if k >= 2 else 1)) < 1e-9
        assert abs(r["m"] - min(0.02 + 0.3 * k, 0.6)) < 0.05
        assert abs(r["b"] - (0.2 if k >= 3 else 0)) < 0.05


def test_a_single_row_gets_no_shared_key(spark):
    rows = spark.createDataFrame([(1.0, "b", 2001, "K1", "2024-01-01")], "price double, brand string, year int, vin string, posting_date string")
    for seed in range(12):
        out = inject.inject_defects(rows, F.col("vin"), 1.0, "2024-02-01", seed).first()
        assert out["vin"] == "K1" and out["_defect"] != inject.DUPLICATE_VIN
