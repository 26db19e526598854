"""CSV scan that keeps every row, and the header and type normalisation behind it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from batchwarden.functions.coerce import missing_to_null, nan_to_null, to_number, to_utc_timestamp
from batchwarden.profile import TableProfile


def normalise_headers(df: DataFrame, column_map: Mapping[str, str]) -> DataFrame:
    """Strip and lower-case the column names, then rename them by the (lower-cased) map."""
    renames = {source.lower(): target for source, target in column_map.items()}
    names = [name.strip().lower() for name in df.columns]
    return df.toDF(*[renames.get(name, name) for name in names])


def coerce_types(
    df: DataFrame, profile: TableProfile, timestamp_formats: Sequence[str] = ()
) -> DataFrame:
    """Numbers as doubles and the date as a UTC timestamp; unusable values become NULL."""
    numeric = set(profile.numeric_columns)
    columns = []
    for column in df.schema.fields:
        value = F.col(f"`{column.name}`")
        if column.name == profile.date_column:
            value = to_utc_timestamp(value, column.dataType, timestamp_formats)
        elif column.name in numeric and not isinstance(column.dataType, T.IntegralType):
            value = to_number(value, column.dataType)
        elif isinstance(column.dataType, (T.FloatType, T.DoubleType)):
            value = nan_to_null(value)
        columns.append(value.alias(column.name))
    return df.select(*columns)


def _texts(spark: SparkSession, files: Sequence[str], breaks: bool) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", breaks).option("escape", '"')
    return reader.option("mode", "PERMISSIVE").csv(list(files))


def _files_by_breaks(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The files that may hold line breaks inside quotes, and those that certainly hold none.

    Up to a line break inside quotes the number of quotes is odd, so some line before it has an odd
    number itself. One row per file comes back.
    """
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))
    found = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.bool_or(quotes % 2 == 1).alias("odd")).collect()
    files = [(unquote(r["file"]), r["odd"]) for r in found]
    broken, whole = [f for f, odd in files if odd], [f for f, odd in files if not odd]
    return (broken, whole) if files else ([], [path])


def read_csv(
    spark: SparkSession,
    path: str,
    profile: TableProfile,
    column_map: Mapping[str, str] | None = None,
    multi_line: bool | None = None,
    timestamp_formats: Sequence[str] = (),
) -> DataFrame:
    """Scan a CSV file as text, then normalise its headers and types; no row is dropped.

    Only files with quoted line breaks are read one file per task, all others are split.  Which ones
    have them is found by a first pass over the lines, unless ``multi_line`` says so for all files.
    """
    if multi_line is None:
        broken, whole = _files_by_breaks(spark, path)
    else:
        broken, whole = ([path], []) if multi_line else ([], [path])
    parts = [_texts(spark, files, breaks) for files, breaks in ((broken, True), (whole, False)) if files]
    raw = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    raw = raw.select(*[missing_to_null(F.col(f"`{c}`")).alias(c) for c in raw.columns])
    mapping = profile.column_map if column_map is None else column_map
    return coerce_types(normalise_headers(raw, mapping), profile, timestamp_formats)
