"""Slicing a table into calendar batches.

A batch is a value of the ``_batch`` column, so that every later operator handles all batches in
one plan.  Per-batch facts are tables with one row per calendar period and are staged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from batchwarden.functions.coerce import date_format, to_utc_timestamp
from batchwarden.functions.periods import period_label, period_start
from batchwarden.profile import TableProfile
from batchwarden.sources.staging import Staged, stage

BATCH = "_batch"
PERIOD = "_period_start"
ALL = "all"


# Columns the engine adds to the data; every other column came with it.
ENGINE_COLUMNS = frozenset(
    {
        BATCH,
        PERIOD,
        "_flags",
        "_is_error",
        "_disposition",
        "_defect",
        "_fingerprint",
        "_repeated_key",
        "_copied_row",
        "_split_key",
    }
)


def is_internal(name: str) -> bool:
    """Whether a column was added by the engine."""
    return name in ENGINE_COLUMNS


def source_columns(df: DataFrame) -> list[str]:
    """The columns that came with the data."""
    return [c for c in df.columns if not is_internal(c)]


def assign_batches(df: DataFrame, profile: TableProfile) -> DataFrame:
    """Add the label and start of each row's calendar period; undated rows belong to no batch."""
    dtype = df.schema[profile.date_column].dataType
    stamp = to_utc_timestamp(F.col(profile.date_column), dtype)
    start = period_start(stamp, profile.freq)
    return (
        df.withColumn(PERIOD, start)
        .filter(F.col(PERIOD).isNotNull())
        .withColumn(BATCH, period_label(F.col(PERIOD), profile.freq))
    )


def undated_rows(df: DataFrame, profile: TableProfile) -> DataFrame:
    """How many rows no batch will hold, because their date is missing or unreadable."""
    dtype = df.schema[profile.date_column].dataType
    stamp = to_utc_timestamp(F.col(profile.date_column), dtype)
    return df.agg(F.count_if(stamp.isNull()).alias("n_undated"), F.count(F.lit(1)).alias("n_rows"))


def date_formats(df: DataFrame, profile: TableProfile) -> DataFrame:
    """Rows by the rendering of their date; ``missing`` and ``unreadable`` ones are in no batch."""
    date = F.col(profile.date_column)
    found = date_format(date, df.schema[profile.date_column].dataType)
    name = F.when(date.isNull(), F.lit("missing")).otherwise(F.coalesce(found, F.lit("unreadable")))
    return df.groupBy(name.alias("format")).agg(F.count(F.lit(1)).alias("n_rows"))


def single_batch(df: DataFrame, label: str = ALL) -> DataFrame:
    """The whole table as one batch; no row is left out and no minimum size applies."""
    nowhere = F.lit(None).cast("timestamp")
    return df.withColumn(PERIOD, nowhere).withColumn(BATCH, F.lit(label))


def batch_sizes(batched: DataFrame, extra: Sequence = ()) -> DataFrame:
    """Row count per batch, with further aggregates on request."""
    n_rows = F.count(F.lit(1)).alias("n_rows")
    return batched.groupBy(BATCH, PERIOD).agg(n_rows, *extra)


def keep_batches(batched: DataFrame, batches: Staged) -> DataFrame:
    """The rows of the listed batches."""
    return batched.join(batches.side().select(BATCH), BATCH, "left_semi")


def drop_small_batches(batched: DataFrame, min_rows: int) -> DataFrame:
    """Leave out batches with fewer than ``min_rows`` rows.

    Sizes are aggregated on the map side first, so a batch holding most rows is never gathered.
    """
    sizes = batch_sizes(batched).filter(F.col("n_rows") >= min_rows)
    return keep_batches(batched, stage(sizes.select(BATCH), "batches"))


def batch_counts(batched: DataFrame, min_rows: int) -> DataFrame:
    """The batches of a table in chronological order, with position, size and fate.

    The window runs over one row per calendar period, not over the table.
    """
    in_order = Window.partitionBy(F.lit(0)).orderBy(PERIOD)
    return (
        batch_sizes(batched)
        .withColumn("position", F.row_number().over(in_order) - 1)
        .withColumn("kept", F.col("n_rows") >= min_rows)
    )


def empty_batch(batched: DataFrame, label: str = ALL) -> DataFrame:
    """One row naming a batch that holds no data, so that an empty table is still reported."""
    schema = T.StructType(
        [T.StructField(BATCH, T.StringType()), T.StructField(PERIOD, T.TimestampType())]
    )
    return batched.sparkSession.createDataFrame([(label, None)], schema)
