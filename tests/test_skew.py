"""Large and uneven inputs: hot keys, copies, keyless rows, ranks and percentiles."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import whole_report
from pyspark.sql import functions as F

from batchwarden.operators import duplicates, membership, quantiles, ranks
from batchwarden.operators.batching import single_batch
from batchwarden.operators.membership import look_up
from batchwarden.profiles import VEHICLES
from batchwarden.sources import staging


def _uneven(spark):
    """3,000 rows: a third share one key, a third are keyless copies, the rest are unique pairs."""
    n = F.col("id")
    vin = F.when(n % 3 == 0, F.lit("HOT")).when(n % 3 == 2, F.concat(F.lit("V"), F.floor(n / 6).cast("string")))
    price = F.when(n % 3 == 1, F.when(n % 300 == 1, n).otherwise(F.lit(7))).otherwise(n)
    return spark.range(3000).select(vin.alias("vin"), price.cast("double").alias("price"))


def _expected(rows):
    keys = rows.groupby("vin", dropna=False)["vin"].transform("size")
    repeated = rows["vin"].notna() & rows.groupby("vin")["vin"].transform("size").gt(1)
    copied = rows.duplicated(keep=False)
    assert len(keys) == len(rows)
    return repeated, copied


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_duplicates_of_uneven_rows(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(staging, "BROADCAST_ROWS", broadcast_rows)
    df = _uneven(spark)
    batched = single_batch(df)
    found = duplicates.find_duplicates(batched, "vin")
    marked = duplicates.mark_duplicates(batched, found).toPandas()
    repeated, copied = _expected(marked[["vin", "price"]])
    assert len(marked) == 3000
    assert (marked[duplicates.REPEATED_KEY] == repeated).all()
    hit = marked[duplicates.REPEATED_KEY] | marked[duplicates.COPIED_ROW]
    assert (hit == (repeated | copied)).all()
    assert found.copies_per_batch().first()["n_copies"] == copied.sum()


def test_hot_and_keyless_rows_are_not_shuffled_by_key(spark, monkeypatch):
    monkeypatch.setattr(staging, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batched = single_batch(_uneven(spark))
        found = duplicates.find_duplicates(batched, "vin")
        marked = membership.mark_members(batched, found.keys, ["_batch", "vin"], "hit")
        shuffled = marked.filter(~F.col("hit"))
        plan = marked._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        assert shuffled.filter("vin = 'HOT'").isEmpty()
        assert marked.count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fingerprint_collisions_do_not_count_as_copies(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "fingerprint", lambda df, columns: F.lit(1).cast("bigint"))
    df = spark.createDataFrame([(1, None), (2, None), (2, None), (3, "a")], "x int, vin string")
    batched = single_batch(df)
    found = duplicates.find_duplicates(batched, "vin")
    marked = duplicates.mark_duplicates(batched, found)
    assert sorted(r["x"] for r in marked.filter(duplicates.COPIED_ROW).collect()) == [2, 2]


def test_negative_zero_equals_zero(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,)], "price double")
    report = whole_report(df, VEHICLES.but(min_rows=1, schema=(), required=()))
    assert report.flagged.filter("array_contains(_flags, 'duplicates')").count() == 2


@pytest.mark.parametrize("kind", ["smooth", "ties", "uneven", "tiny"])
def test_percentiles_are_exact(spark, kind):
    rng = np.random.default_rng(1)
    big = {
        "smooth": rng.normal(size=4000),
        "ties": rng.integers(0, 7, size=4000).astype(float),
        "uneven": np.where(rng.random(4000) < 0.4, 5.0, rng.exponential(size=4000) ** 4),
        "tiny": rng.normal(size=2),
    }[kind]
    rows = [("a", float(v), 1.0) for v in big] + [("b", float(v), None) for v in (3, 1, 2)]
    rows += [("b", None, None), ("c", None, None)]
    df = spark.createDataFrame(rows, "g string, v double, w double").repartition(7)
    shares = [i / 10 for i in range(11)]
    out = quantiles.exact_percentiles(df, ["g"], {"q": F.col("v"), "ones": F.col("w")}, shares)
    found = {r["g"]: r for r in out.collect()}
    assert set(found) == {"a", "b"} and found["b"]["ones"] is None and set(found["a"]["ones"]) == {1.0}
    assert np.allclose(found["a"]["q"], np.percentile(big, np.linspace(0, 100, 11)), rtol=0, atol=1e-12)
    assert np.allclose(found["b"]["q"], np.percentile([1, 2, 3], np.linspace(0, 100, 11)))


def test_percentiles_of_one_group_use_many_tasks(spark):
    """Only counts of ranges meet in one task, never values."""
    df = spark.range(100_000).select((F.col("id") % 1).alias("g"), F.rand(3).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = quantiles.exact_percentiles(df, ["g"], {"q": F.col("v")}, [0.25, 0.5])
        assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
        found = out.first()["q"]
        assert quantiles.exact_percentiles(df, [], {"q": F.col("v")}, [0.25, 0.5]).first()["q"] == found
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert abs(found[1] - 0.5) < 0.01 and abs(found[0] - 0.25) < 0.01


def test_numbered_rows_follow_the_order(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("k"), (F.col("id") % 3).alias("g"))
    rows = ranks.numbered(df.repartition(9), ["g", "k"], "place").df.collect()
    assert [r["place"] for r in sorted(rows, key=lambda r: (r["g"], r["k"]))] == list(range(10_000))


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_facts_of_a_hot_key(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(staging, "BROADCAST_ROWS", broadcast_rows)
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    rows = rows.unionByName(spark.range(9).select("id", F.lit(None).cast("string").alias("k")))
    facts = rows.filter("k IS NOT NULL AND (k = 'hot' OR k < '5')").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    facts = staging.stage(facts.withColumn("size", F.length("k")), "facts")
    out = look_up(rows, facts, ["k"], {"width": "size"}, "known").collect()
    assert len(out) == 3009
    for r in out:
        known = r["k"] is not None and (r["k"] == "hot" or r["k"] < "5")
        assert r["known"] == known and r["width"] == (len(r["k"]) if known else None)


def test_wide_rows_are_not_broadcast(spark, monkeypatch):
    """A short list of long texts is judged by its bytes."""
    few = spark.range(20).select("id", F.repeat(F.lit("x"), 5000).alias("note"), F.array("id").alias("ids"))
    held = staging.stage(few, "wide")
    assert held.rows == 20 and held.bytes > 20 * 5000
    assert held.fits and staging.measured(held.df).bytes == held.bytes
    monkeypatch.setattr(staging, "BROADCAST_BYTES", 50_000)
    assert not held.fits
    assert staging.stage(few.limit(0), "none").bytes == 0


def test_rows_told_apart_by_two_fingerprints_are_not_compared(spark, monkeypatch):
    """Pairs of different rows under one key are settled by the key counts; copies are still found."""
    rows = [("two", 1.0), ("two", 2.0), ("same", 3.0), ("same", 3.0), ("three", 4.0), ("three", 4.0), ("three", 5.0), ("own", 6.0), (None, 7.0), (None, 7.0)]
    compared = []
    plain = duplicates.copied_rows

    def counted(candidates, columns):
        compared.append(sorted(str(r["vin"]) for r in candidates.collect()))
        return plain(candidates, columns)

    monkeypatch.setattr(duplicates, "copied_rows", counted)
    batched = single_batch(spark.createDataFrame(rows, "vin string, price double"))
    found = duplicates.find_duplicates(batched, "vin")
    assert compared == [["None", "None", "same", "same", "three", "three", "three"]]
    assert found.copies_per_batch().first()["n_copies"] == 6
    marked = duplicates.mark_duplicates(batched, found).collect()
    assert {r["vin"] for r in marked if r[duplicates.REPEATED_KEY]} == {"two", "same", "three"}
    assert [r["vin"] for r in marked if r[duplicates.COPIED_ROW]] == [None, None]
