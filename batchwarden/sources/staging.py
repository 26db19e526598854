"""Intermediate results written once to the shared folder.

A staged table has no lineage to replay when an executor is lost, and its size is known: that is
what decides whether it may be broadcast.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from batchwarden.session import shared_folder

# A side with more rows or more bytes than this is joined by a shuffle.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
_ROW_BYTES = 16


@dataclass(frozen=True)
class Staged:
    """A written intermediate table, its exact row count, and the measured bytes of its values."""

    df: DataFrame
    rows: int
    bytes: int

    @property
    def fits(self) -> bool:
        """Whether the table is small enough to be sent to every executor."""
        return self.rows <= BROADCAST_ROWS and self.bytes <= BROADCAST_BYTES

    def side(self) -> DataFrame:
        """The table as a join side: broadcast when its counted size allows it."""
        return F.broadcast(self.df) if self.fits else self.df


def row_bytes(df: DataFrame) -> Column:
    """The bytes that the values of a row take: texts by their length, other nested values than numbers by their JSON."""

    def width(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0))
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
            return 8 * F.coalesce(F.array_size(value), F.lit(0))
        if isinstance(kind, T.StructType):
            return sum((width(value[f.name], f.dataType) for f in kind.fields), F.lit(0))
        if isinstance(kind, (T.ArrayType, T.MapType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
        return F.lit(8)

    return sum((width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(_ROW_BYTES)).cast("bigint")


def measured(df: DataFrame) -> Staged:
    """A table that is already written, counted and measured by one pass over it."""
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()
    return Staged(df, size["rows"], size["bytes"])


def counted_write(df: DataFrame, path: str, mode: str, partition_by: tuple[str, ...] = ()) -> int:
    """Write a parquet table and return its row count, counted while writing.

    Mode ``refresh`` overwrites only the partitions the rows fall into.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    kind = "dynamic" if mode == "refresh" else "static"
    writer = counted.write.mode("overwrite" if mode == "refresh" else mode)
    writer = writer.option("partitionOverwriteMode", kind)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(seen.get["rows"])


def stage(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), read_as: T.StructType | None = None) -> Staged:
    """Write ``df`` under the shared folder and return the written table, perhaps read as other types of the same layout."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/batchwarden/{label}-{uuid.uuid4().hex}"
    seen = Observation()
    size = F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")
    writer = df.observe(seen, *size).write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return Staged(spark.read.schema(read_as or df.schema).parquet(path), int(seen.get["rows"]), int(seen.get["bytes"]))

