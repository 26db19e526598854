"""Coercions that turn unusable values into NULL instead of failing or dropping the row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

# Texts a CSV reader takes for a missing value.
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Spark's cast also takes type suffixes such as "1d", so the text is matched first.
NUMBER_PATTERN = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"


# Renderings of a date besides ISO, tried in this order: name, shape of the text, pattern. A date of
# three numbers with the year last has the month first.
DATE_FORMATS = (
    ("year_first", r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    ("year_first_time", r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}$", "yyyy/M/d H:mm:ss"),
    ("month_first", r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    ("month_first_time", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
    ("month_first_minutes", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm"),
    ("half_day", r"(?i)^\d{4}-\d{2}-\d{2} \d{1,2}:\d{2} [ap]m$", "yyyy-MM-dd h:mm a"),
    ("half_day_seconds", r"(?i)^\d{4}-\d{2}-\d{2} \d{1,2}:\d{2}:\d{2} [ap]m$", "yyyy-MM-dd h:mm:ss a"),
    ("short_month", r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    ("long_month", r"^[A-Za-z]{3,9} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    ("day_month", r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    ("digits", r"^\d{8}$", "yyyyMMdd"),
)
ISO = "iso"
# Shape of the texts that are read as ISO dates or timestamps.
ISO_SHAPE = r"^[+-]?\d{4,}(-\d{1,2}(-\d{1,2}([T ].*)?)?)?$"


def nan_to_null(column: Column) -> Column:
    """A double column with NaN replaced by NULL."""
    return F.nanvl(column, F.lit(None).cast("double"))


def to_number(column: Column, dtype: T.DataType) -> Column:
    """The column as a double; text that is no number, and NaN, become NULL."""
    if isinstance(dtype, T.StringType):
        text = F.trim(column)
        return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return nan_to_null(column.cast("double"))
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    return F.lit(None).cast("double")


def to_utc_timestamp(
    column: Column, dtype: T.DataType, formats: Sequence[str] = ()
) -> Column:
    """The column as a timestamp in the session zone; text that is no date becomes NULL.

    Texts are read as ISO dates or timestamps (an offset is honoured), then by each of ``formats``,
    then by the first of ``DATE_FORMATS`` that fits their shape.
    """
    if isinstance(dtype, T.StringType):
        text = F.trim(column)
        tries = [F.when(text.rlike(ISO_SHAPE), F.try_to_timestamp(text))]
        tries += [F.try_to_timestamp(text, F.lit(f)) for f in formats]
        tries += [stamp for _, stamp in _by_format(text)]
        return F.coalesce(*tries)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return column.cast("timestamp")
    return F.lit(None).cast("timestamp")


def _by_format(text: Column) -> list[tuple[str, Column]]:
    """The text read by each known rendering; only texts of its shape are parsed."""
    return [(name, F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(pattern)))) for name, shape, pattern in DATE_FORMATS]


def date_format(column: Column, dtype: T.DataType) -> Column:
    """Which rendering a date is read by: ``typed``, ``iso``, one of ``DATE_FORMATS``, or NULL for none."""
    if not isinstance(dtype, T.StringType):
        return F.when(to_utc_timestamp(column, dtype).isNotNull(), F.lit("typed"))
    text = F.trim(column)
    found = F.when(F.when(text.rlike(ISO_SHAPE), F.try_to_timestamp(text)).isNotNull(), F.lit(ISO))
    for name, stamp in _by_format(text):
        found = found.when(stamp.isNotNull(), F.lit(name))
    return found


def missing_to_null(column: Column) -> Column:
    """A text column with the missing-value tokens replaced by NULL."""
    return F.when(~column.isin(*MISSING_TOKENS), column)


def is_missing(column: Column, dtype: T.DataType) -> Column:
    """True for NULL, and for NaN in a floating column."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()
