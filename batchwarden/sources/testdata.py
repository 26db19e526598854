"""The monitored test tables: the event stream, and listings derived from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from batchwarden.profiles import EVENTS, LISTINGS
from batchwarden.sources.csv import coerce_types

_LISTINGS = """
SELECT concat('V', l_orderkey, '-', l_linenumber, '-', l_suppkey) AS vin,
       concat('V', l_orderkey, '-', l_linenumber) AS vin_strict,
       p_brand AS brand, p_name AS model, p_type AS condition,
       l_returnflag AS title_status, l_linestatus AS state,
       CAST(1995 + p_size % 30 AS INT) AS year,
       l_quantity * CAST(3000 AS DOUBLE) AS mileage,
       o_orderdate AS posting_date,
       (CAST(3000 AS DOUBLE) + CAST(substr(p_brand, 7) AS INT) * CAST(400 AS DOUBLE)
         + (p_size % 30) * CAST(450 AS DOUBLE) - l_quantity * CAST(120 AS DOUBLE)
         + l_extendedprice / CAST(50 AS DOUBLE)) AS price
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
              JOIN {part} ON l_partkey = p_partkey
"""
_TABLES = ("lineitem", "orders", "part")
LISTINGS_SQL = _LISTINGS.format(**{name: name for name in _TABLES})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream with normalised types."""
    return coerce_types(spark.read.parquet(f"{sf_dir}/events.parquet"), EVENTS)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings joined from orders, their lines and the parts, with normalised types."""
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in _TABLES}
    return coerce_types(spark.sql(_LISTINGS, **tables), LISTINGS)
