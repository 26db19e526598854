"""Ranks over tables of any size: sorted in ranges, counted per range, placed by the counts before.

The values are dealt into consecutive ranges over the tasks. One count per range is all that has to be
brought into order in one place; a rank is then found inside its own range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from batchwarden.sources.staging import Staged, stage

# monotonically_increasing_id keeps the number of the range above this many bits.
_RANGE_BITS = 33
_RANGE = "_range"


def numbered(df: DataFrame, order: list[str], name: str) -> Staged:
    """The rows with their place 0, 1, ... in the given order, which should tell all rows apart."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = stage(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_at", _RANGE_BITS)
    sizes = kept.df.groupBy(part.alias(_RANGE)).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy(_RANGE)) - F.col("_n")
    starts = stage(sizes.select(_RANGE, before.alias("_start")), "range-starts")
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << _RANGE_BITS) - 1))
    rows = kept.df.withColumn(_RANGE, part).join(starts.side(), _RANGE)
    return Staged(rows.withColumn(name, place).drop(_RANGE, "_at", "_start"), kept.rows, kept.bytes)


def at_ranks(counts: DataFrame, by: list[str], value: str, n: str, wanted) -> DataFrame:
    """The values at wanted ranks of each group: (*by, ``wanted`` columns, value).

    ``counts`` holds each value of a group once, with the number ``n`` of its rows, and is read twice.
    ``wanted(total)`` gives an array of structs with a field ``rank`` (from 0) for a group of ``total``
    rows. Each rank is looked for only in the range that holds it, as the counts before tell.
    """
    ranged = counts.repartitionByRange(*by, value).withColumn(_RANGE, F.spark_partition_id())
    kept = stage(ranged, "value-ranges")
    sizes = kept.df.groupBy(*by, _RANGE).agg(F.sum(n).alias("_in_range"))
    group = Window.partitionBy(*by)
    sizes = sizes.select(
        *by,
        _RANGE,
        "_in_range",
        (F.sum("_in_range").over(group.orderBy(_RANGE)) - F.col("_in_range")).alias("_before"),
        F.sum("_in_range").over(group).alias("_total"),
    )
    sought = sizes.withColumn("_w", F.explode(wanted(F.col("_total"))))
    rank = F.col("_w.rank")
    sought = sought.filter((rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_in_range")))
    sought = stage(sought.select(*by, _RANGE, "_before", "_w"), "wanted-ranks")

    holding = sought.df.select(*by, _RANGE).distinct()
    holding = F.broadcast(holding) if sought.fits else holding
    rows = kept.df.join(holding, [*by, _RANGE], "left_semi")
    upto = F.sum(n).over(Window.partitionBy(*by, _RANGE).orderBy(value))
    rows = rows.withColumn("_upto", upto)
    found = rows.join(sought.side(), [*by, _RANGE])
    last = F.col("_before") + F.col("_upto")
    found = found.filter((rank < last) & (rank >= last - F.col(n)))
    return found.select(*by, "_w.*", value)
