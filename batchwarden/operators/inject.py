"""Fault injection: corrupt a table in known ways, to measure what the checks catch.

Which rows are hit is decided by a hash of the row's key, so the same rows are hit in every run and
on every partitioning, and the ground truth is recorded in the row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from batchwarden.functions.hashing import fraction, hash32
from batchwarden.functions.periods import period_start

DEFECT = "_defect"

# The injected defects.
NULL_BRAND = "null_brand"
NONPOSITIVE_PRICE = "nonpositive_price"
IMPOSSIBLE_YEAR = "impossible_year"
DUPLICATE_VIN = "duplicate_vin"
STALE_DATE = "stale_date"
DEFECTS = (NULL_BRAND, NONPOSITIVE_PRICE, IMPOSSIBLE_YEAR, DUPLICATE_VIN, STALE_DATE)
SHARED_VIN = "DUPLICATE-VIN"
IMPOSSIBLE_YEARS = (1400, 1800, 1900, 2035, 2100, 3000)
STALE_DAYS = 5 * 365

_RESOLUTION = 10_000


@dataclass(frozen=True)
class DefectRoles:
    """Columns the defects are written to."""

    brand: str = "brand"
    price: str = "price"
    year: str = "year"
    vin: str = "vin"
    date: str = "posting_date"


def inject_defects(
    df: DataFrame,
    key: Column,
    bad_fraction: float,
    anchor: str,
    seed: int = 42,
    roles: DefectRoles = DefectRoles(),
) -> DataFrame:
    """Corrupt about ``bad_fraction`` of the rows, in equal parts per defect.

    ``_defect`` names what was done to a row.  Bad prices alternate between zero and a negative
    amount; all rows of the duplicate defect share one key, if there are at least two; stale rows get a date five years
    before ``anchor``.
    """
    draw = hash32(seed, key)
    rank = draw % _RESOLUTION
    chosen = rank < int(round(bad_fraction * _RESOLUTION))
    group = F.element_at(F.array(*[F.lit(d) for d in DEFECTS]), (rank % 5 + 1).cast("int"))
    rows = df.withColumn(DEFECT, F.when(chosen, group)).withColumn("_draw", hash32(f"{seed}v", key))

    def hit(defect: str) -> Column:
        return F.coalesce(F.col(DEFECT) == defect, F.lit(False))

    # One row alone cannot repeat a key; it is then left as it was.
    if rows.filter(hit(DUPLICATE_VIN)).limit(2).count() < 2:
        rows = rows.withColumn(DEFECT, F.when(~hit(DUPLICATE_VIN), F.col(DEFECT)))
    pick = F.col("_draw")
    years = F.array(*[F.lit(y) for y in IMPOSSIBLE_YEARS])
    year = F.element_at(years, (pick % len(IMPOSSIBLE_YEARS) + 1).cast("int"))
    price = F.when(pick % 2 == 0, F.lit(0.0)).otherwise(-(pick % 5000 + 1).cast("double"))
    stale = F.lit(anchor).cast("timestamp") - F.make_dt_interval(F.lit(STALE_DAYS))
    new = {
        roles.brand: (NULL_BRAND, F.lit(None)),
        roles.price: (NONPOSITIVE_PRICE, price),
        roles.year: (IMPOSSIBLE_YEAR, year),
        roles.vin: (DUPLICATE_VIN, F.lit(SHARED_VIN)),
        roles.date: (STALE_DATE, stale),
    }
    changed = {
        column: F.when(hit(defect), value.cast(df.schema[column].dataType)).otherwise(F.col(column))
        for column, (defect, value) in new.items()
    }
    return rows.withColumns(changed).drop("_draw")


def defect_counts(df: DataFrame) -> DataFrame:
    """Ground truth: rows hit per defect."""
    hit = df.filter(F.col(DEFECT).isNotNull())
    return hit.groupBy(DEFECT).agg(F.count(F.lit(1)).alias("n_rows"))


@dataclass(frozen=True)
class DriftSpec:
    """Gradual and sudden changes over the periods of a table (period 0 is the first)."""

    inflation: float = 0.0
    shock_period: int | None = None
    shock_multiplier: float = 1.0
    rising_null_column: str | None = None
    null_base: float = 0.02
    null_step: float = 0.03
    null_limit: float = 0.6
    new_category_period: int | None = None
    category_column: str = "brand"
    new_category: str = "new-brand"
    new_category_share: float = 0.20


_MONTHS = {"M": 1, "Q": 3, "Y": 12, "A": 12}
_DAYS = {"W": 7, "D": 1}


def period_number(ts: Column, freq: str, first: str) -> Column:
    """Periods since the one that ``first`` falls into."""
    start = period_start(ts, freq)
    origin = period_start(F.lit(first).cast("timestamp"), freq)
    unit = freq.upper()[0]
    if unit in _DAYS:
        return F.floor(F.datediff(start, origin) / _DAYS[unit]).cast("int")
    months = (F.year(start) - F.year(origin)) * 12 + F.month(start) - F.month(origin)
    return F.floor(months / _MONTHS[unit]).cast("int")


def inject_drift(
    df: DataFrame,
    key: Column,
    spec: DriftSpec,
    freq: str,
    first: str,
    seed: int = 42,
    price: str = "price",
    date: str = "posting_date",
) -> DataFrame:
    """Apply the changes of ``spec``; rows dated before ``first`` are left as they are."""
    k = F.greatest(period_number(F.col(date), freq, first), F.lit(0))
    rows = df.withColumn("_k", F.coalesce(k, F.lit(0)))
    k = F.col("_k")
    value = F.col(price) * F.pow(F.lit(1.0 + spec.inflation), k)
    if spec.shock_period is not None:
        value = F.when(k >= spec.shock_period, value * spec.shock_multiplier).otherwise(value)
    changed = {price: value}
    if spec.rising_null_column:
        column = spec.rising_null_column
        share = F.least(
            F.greatest(spec.null_base + spec.null_step * k, F.lit(0.0)), F.lit(spec.null_limit)
        )
        kept = fraction(f"{seed}n", key) >= share
        changed[column] = F.when(kept, changed.get(column, F.col(column)))
    if spec.new_category_period is not None:
        appears = (k >= spec.new_category_period) & (
            fraction(f"{seed}c", key) < spec.new_category_share
        )
        changed[spec.category_column] = F.when(appears, F.lit(spec.new_category)).otherwise(
            F.col(spec.category_column)
        )
    return rows.withColumns(changed).drop("_k")
