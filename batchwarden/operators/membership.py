"""Facts about keys attached to the rows of a large table, whatever the keys' skew."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from batchwarden.sources.staging import Staged, stage

# Keys with more than this share of all listed rows are split off; fewer than this many can exist.
HOT_KEYS = 1000
# Bits that tell which keys cannot be listed, in maps of 32,768 bits each: 16 MiB whatever is listed.
FILTER_BITS = 1 << 27
_MAP_BITS = 1 << 15


def possible(rows: DataFrame, listed: DataFrame, on: list[str], flag: str) -> DataFrame:
    """Add a boolean column that is true for every row whose key is listed, and for few others.

    The hashes of all listed keys are set in bit maps of a bounded size, which every task can hold; so
    rows that certainly match nothing need not be shuffled.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(FILTER_BITS))
    bits = listed.select(place.alias("_p")).select(
        F.floor(F.col("_p") / _MAP_BITS).cast("int").alias("_map"), (F.col("_p") % _MAP_BITS).alias("_bit")
    )
    maps = stage(bits.groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "key-filter").df
    rows = rows.withColumn("_p", place).withColumn("_map", F.floor(F.col("_p") / _MAP_BITS).cast("int"))
    bit = F.col("_p") % _MAP_BITS
    # FILTER_BITS / _MAP_BITS maps at most.
    joined = rows.join(F.broadcast(maps), "_map", "left")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.expr("shiftright({byte}, CAST(_p % 8 AS INT)) & 1 = 1".replace("{byte}", "_byte"))
    joined = joined.withColumn("_byte", byte).withColumn(flag, F.coalesce(held, F.lit(False)))
    return joined.drop("_map", "_bits", "_byte", "_p")


def _joined(
    rows: DataFrame, facts: DataFrame, on: list[str], same: list[str], columns: dict[str, str], found: str
) -> DataFrame:
    """Left join with a flag; ``same`` columns are compared null-safely besides the key."""
    values = [F.col(source).alias(f"_v_{i}") for i, source in enumerate(columns.values())]
    renamed = facts.select(*[F.col(c).alias(f"_m_{c}") for c in on + same], *values, F.lit(True).alias("_m"))
    tests = [F.col(c) == F.col(f"_m_{c}") for c in on]
    tests += [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in same]
    joined = rows.join(renamed, reduce(Column.__and__, tests), "left")
    taken = [F.col(f"_v_{i}").alias(target) for i, target in enumerate(columns)]
    return joined.select(*rows.columns, *taken, F.coalesce(F.col("_m"), F.lit(False)).alias(found))


def look_up(
    rows: DataFrame,
    facts: Staged,
    on: list[str],
    columns: dict[str, str],
    found: str,
    same: list[str] | None = None,
) -> DataFrame:
    """Add columns of the fact with the row's key, NULL without one, and whether there is one.

    ``facts`` holds each key once, with the number ``n`` of rows that carry it; ``columns`` names the
    new columns and what they are in ``facts``. A small table is broadcast. Otherwise the keys that
    carry a large share of the rows (at most ``HOT_KEYS`` can) are broadcast, rows with those keys or
    without a key are settled on the spot, as are rows that a bit map of all listed keys rules out, and
    only the evenly spread remainder is joined by a shuffle.
    """
    same = same or []
    if facts.rows == 0:
        types = {target: facts.df.schema[source].dataType for target, source in columns.items()}
        empty = [F.lit(None).cast(kind).alias(target) for target, kind in types.items()]
        return rows.select(*rows.columns, *empty, F.lit(False).alias(found))
    if facts.fits:
        return _joined(rows, F.broadcast(facts.df), on, same, columns, found)

    total = facts.df.agg(F.sum("n")).first()[0]
    limit = total // HOT_KEYS
    hot = facts.df.filter(F.col("n") > limit)
    rest = facts.df.filter(F.col("n") <= limit)
    keyed = reduce(Column.__and__, [F.col(c).isNotNull() for c in on])
    first = _joined(rows, F.broadcast(hot), on, same, columns, found)
    first = possible(first, rest, on, "_possible")
    is_open = ~F.col(found) & keyed & F.col("_possible")
    settled = first.filter(~F.coalesce(is_open, F.lit(False))).drop("_possible")
    open_rows = first.filter(is_open).select(*rows.columns)
    return settled.unionByName(_joined(open_rows, rest, on, same, columns, found))


def mark_members(
    rows: DataFrame, members: Staged, on: list[str], flag: str, same: list[str] | None = None
) -> DataFrame:
    """Add a boolean column telling whether the row's key is among ``members``."""
    return look_up(rows, members, on, {}, flag, same)
