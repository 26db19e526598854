"""Exact percentiles per group, at any group size and on one path.

Values are folded to distinct values with their counts on the map side, dealt into ranges, and the two
ranks beside each wanted percentile are looked up in the ranges that hold them (see ``ranks``). No task
ever holds the values of a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from batchwarden.operators.ranks import at_ranks
from batchwarden.sources.staging import stage


def exact_percentiles(
    df: DataFrame, by: list[str], values: dict[str, Column], shares: list[float]
) -> DataFrame:
    """Linearly interpolated percentiles of each value per group, as one array column each.

    NULL values do not count; a group without any value of a column has NULL there, and a group
    without any value at all is left out. ``values`` must be doubles.
    """
    entries = [F.struct(F.lit(name).alias("_name"), v.alias("_v")) for name, v in values.items()]
    long = df.select(*by, F.inline(F.array(*entries))).filter(F.col("_v").isNotNull())
    counts = long.groupBy(*by, "_name", "_v").agg(F.count(F.lit(1)).alias("_c"))
    counts = stage(counts, "value-counts").df

    def wanted(total: Column) -> Column:
        """Both ranks beside every share, each with the weight of its value."""
        both = []
        for i, share in enumerate(shares):
            place = F.lit(share) * (total - 1)
            low, high = F.floor(place), F.ceil(place)
            both.append(F.struct(F.lit(i).alias("i"), F.lit(False).alias("upper"), low.alias("rank"), (high - place).alias("weight")))
            both.append(F.struct(F.lit(i).alias("i"), F.lit(True).alias("upper"), high.alias("rank"), (place - low).alias("weight")))
        return F.array(*both)

    at = at_ranks(counts, [*by, "_name"], "_v", "_c", wanted)
    picked = at.groupBy(*by).agg(*[_array(name, i).alias(f"_{name}_{i}") for name in values for i in range(len(shares))])
    return picked.select(*by, *[_percentiles(name, len(shares)).alias(name) for name in values])


def _array(name: str, i: int) -> Column:
    """The lower and the upper value beside one share, with their weights."""
    here = (F.col("_name") == name) & (F.col("i") == i)
    entry = F.struct(F.col("_v").alias("v"), F.col("weight").alias("w"))
    return F.struct(
        F.max(F.when(here & ~F.col("upper"), entry)).alias("low"), F.max(F.when(here & F.col("upper"), entry)).alias("high")
    )


def _percentiles(name: str, n: int) -> Column:
    """The interpolated percentiles of one value; NULL where the group has none."""
    found = []
    for i in range(n):
        low, high = F.col(f"_{name}_{i}.low"), F.col(f"_{name}_{i}.high")
        mixed = low["w"] * low["v"] + high["w"] * high["v"]
        found.append(F.when(low["v"] == high["v"], low["v"]).otherwise(mixed))
    return F.when(F.col(f"_{name}_0.low").isNotNull(), F.array(*found))
