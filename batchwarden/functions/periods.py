"""Calendar periods and their labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_UNITS = {"D": "day", "M": "month", "Q": "quarter", "Y": "year", "A": "year"}
_WEEK_ENDS = ("SUN", "MON", "TUE", "WED", "THU", "FRI", "SAT")


def _week_shift(freq: str) -> int | None:
    """Days from Monday to the first day of a weekly period; None for other frequencies."""
    head, _, end = freq.upper().partition("-")
    if head != "W":
        return None
    if end and end not in _WEEK_ENDS:
        raise ValueError(f"unknown week anchor in frequency {freq!r}")
    return _WEEK_ENDS.index(end) if end else 0


def period_start(ts: Column, freq: str) -> Column:
    """First instant of the calendar period the timestamp falls into."""
    shift = _week_shift(freq)
    if shift is None:
        if freq.upper() not in _UNITS:
            raise ValueError(f"unsupported batch frequency {freq!r}")
        return F.date_trunc(_UNITS[freq.upper()], ts)
    if shift == 0:
        return F.date_trunc("week", ts)
    days = F.make_dt_interval(F.lit(shift))
    return F.date_trunc("week", ts - days) + days


def period_label(start: Column, freq: str) -> Column:
    """Readable label of a period: ISO year-week for weeks, the calendar unit otherwise."""
    if _week_shift(freq) is not None:
        week = F.lpad(F.weekofyear(start).cast("string"), 2, "0")
        return F.concat(F.extract(F.lit("YEAROFWEEK"), start).cast("string"), F.lit("-W"), week)
    unit = _UNITS[freq.upper()]
    if unit == "quarter":
        year = F.year(start).cast("string")
        return F.concat(year, F.lit("Q"), F.quarter(start).cast("string"))
    return F.date_format(start, {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}[unit])
