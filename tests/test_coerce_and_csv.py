"""Scans keep every row and coerce what they can."""

from __future__ import annotations

import math
import tempfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from batchwarden.functions import coerce
from batchwarden.functions.coerce import is_missing, to_number, to_utc_timestamp
from batchwarden.profiles import VEHICLES
from batchwarden.sources import csv
from batchwarden.sources.csv import coerce_types, normalise_headers, read_csv


def _csv(text: str) -> str:
    path = Path(tempfile.mkdtemp(prefix="run-", dir="/tmp")) / "in.csv"
    path.write_text(text)
    return str(path)


def test_csv_reads_mapped_columns_and_blanks_what_cannot_be_read(spark):
    """Every row stays; a cell that is no number or no time is null, and only that cell."""
    cells = {"price": ["1e4", "1,000", ""], "odometer": ["7", "12 km", "0.5"], "year": ["1999", "'99", "2001.0"]}
    lines = ["Manufacturer;posting_date;vin;" + ";".join(cells)]
    for k, day in enumerate(("2022-02-28T23:59:00", "2022-02-30", "soon")):
        lines.append(f"lada;{day};K{k};" + ";".join(f'"{c[k]}"' for c in cells.values()))
    path = _csv("\n".join(line.replace(",", "\0").replace(";", ",").replace("\0", ",") for line in lines) + "\n")
    rows = {r["vin"]: r for r in read_csv(spark, path, VEHICLES).collect()}
    assert [rows[f"K{k}"]["price"] for k in range(3)] == [10000.0, None, None]
    assert [rows[f"K{k}"]["mileage"] for k in range(3)] == [7.0, None, 0.5]
    assert [rows[f"K{k}"]["year"] for k in range(3)] == [1999.0, None, 2001.0]
    assert [rows[f"K{k}"]["posting_date"] for k in range(3)] == [datetime(2022, 2, 28, 23, 59), None, None]
    assert {r["brand"] for r in rows.values()} == {"lada"}


def test_csv_header_map_of_the_caller_wins(spark):
    path = _csv("Kilometerstand,Marke,Odometer\n31,tatra,99\n")
    row = read_csv(spark, path, VEHICLES, {"kilometerstand": "km_read", "MARKE": "brand"}).first()
    assert row["brand"] == "tatra" and row["km_read"] in (31.0, "31")


def test_csv_quoted_line_breaks_and_missing_tokens(spark):
    path = _csv('vin,brand,price\nV1,"a ""b""\nc",1\nV2,N/A,2\n')
    rows = {r["vin"]: r["brand"] for r in read_csv(spark, path, VEHICLES).collect()}
    assert rows == {"V1": 'a "b"\nc', "V2": None}


@pytest.mark.parametrize(
    "text,value",
    [
        ("12", 12.0),
        (" 1.5 ", 1.5),
        ("-1e3", -1000.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("1d", None),
        ("1_000", None),
        ("", None),
        ("abc", None),
        ("nan", None),
        ("0x10", None),
    ],
)
def test_number_texts(spark, text, value):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(to_number(F.col("x"), df.schema["x"].dataType).alias("v")).first()["v"] == value


def test_infinity_text_is_a_number(spark):
    df = spark.createDataFrame([("-inf",)], "x string")
    found = df.select(to_number(F.col("x"), df.schema["x"].dataType).alias("v")).first()["v"]
    assert math.isinf(found) and found < 0


def test_nan_is_missing_and_coerced_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    dtype = df.schema["x"].dataType
    out = df.select(is_missing(F.col("x"), dtype).alias("m"), to_number(F.col("x"), dtype).alias("v"))
    assert [(r["m"], r["v"]) for r in out.collect()] == [(True, None), (True, None), (False, 1.0)]


@pytest.mark.parametrize(
    "text,value",
    [
        ("2021-05-04", datetime(2021, 5, 4)),
        ("2021-05-04T12:31:18-0500", datetime(2021, 5, 4, 17, 31, 18)),
        ("2021-05-04T12:31:18+02:00", datetime(2021, 5, 4, 10, 31, 18)),
        ("not-a-date", None),
        ("", None),
    ],
)
def test_date_texts_become_utc(spark, text, value):
    df = spark.createDataFrame([(text,)], "x string")
    found = df.select(to_utc_timestamp(F.col("x"), df.schema["x"].dataType).alias("v")).first()
    assert found["v"] == value


def test_extra_date_formats(spark):
    df = spark.createDataFrame([("05/04/2021",)], "posting_date string")
    typed = coerce_types(df, VEHICLES, ("MM/dd/yyyy",))
    assert typed.first()["posting_date"] == datetime(2021, 5, 4)


def test_large_integer_keys_keep_their_digits(spark):
    from batchwarden.profiles import EVENTS

    df = spark.createDataFrame([(2**53 + 1,)], "event_id bigint")
    assert coerce_types(df, EVENTS).first()["event_id"] == 2**53 + 1


def test_headers_are_stripped_lowered_and_renamed(spark):
    df = spark.createDataFrame([(1, 2)], " Odometer int, State int")
    assert normalise_headers(df.toDF(" Odometer", "State "), {"ODOMETER": "mileage"}).columns == [
        "mileage",
        "state",
    ]


@pytest.mark.parametrize(
    "text, want, name",
    [
        ("2021-05-04", "2021-05-04 00:00:00", "iso"),
        ("2021-05-04T12:31:05+02:00", "2021-05-04 10:31:05", "iso"),
        ("05/04/2021", "2021-05-04 00:00:00", "month_first"),
        ("5/4/2021 7:05", "2021-05-04 07:05:00", "month_first_minutes"),
        ("May 4, 2021", "2021-05-04 00:00:00", "short_month"),
        ("september 14, 2021", "2021-09-14 00:00:00", "long_month"),
        ("2021/05/04", "2021-05-04 00:00:00", "year_first"),
        ("2021-05-04 12:31 PM", "2021-05-04 12:31:00", "half_day"),
        ("2021-05-04 12:31 am", "2021-05-04 00:31:00", "half_day"),
        ("4 Dec 2021", "2021-12-04 00:00:00", "day_month"),
        ("20210504", "2021-05-04 00:00:00", "digits"),
        ("13/13/2021", None, None),
        ("Mayday 4, 2021", None, None),
        ("soon", None, None),
    ],
)
def test_renderings_of_a_date(spark, text, want, name):
    df = spark.createDataFrame([(f" {text} ",)], "ts string")
    kind = df.schema["ts"].dataType
    stamp = F.date_format(coerce.to_utc_timestamp(F.col("ts"), kind), "yyyy-MM-dd HH:mm:ss")
    row = df.select(stamp.alias("stamp"), coerce.date_format(F.col("ts"), kind).alias("name")).first()
    assert (row["stamp"], row["name"]) == (want, name)


def test_only_files_with_quoted_breaks_are_read_whole(spark, tmp_path):
    (tmp_path / "a file.csv").write_text('Make,price,vin\nskoda,"1",V1\n"se""at",2,V2\n')
    (tmp_path / "b.csv").write_text('Make,price,vin\n"two\nlines",3,V3\n')
    broken, whole = csv._files_by_breaks(spark, str(tmp_path))
    assert [f.rsplit("/", 1)[1] for f in broken] == ["b.csv"] and [f.rsplit("/", 1)[1] for f in whole] == ["a file.csv"]
    rows = read_csv(spark, str(tmp_path), VEHICLES, {"make": "brand"}).collect()
    assert {(r["brand"], r["price"], r["vin"]) for r in rows} == {("skoda", 1.0, "V1"), ('se"at', 2.0, "V2"), ("two\nlines", 3.0, "V3")}
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "c.csv").write_text("make,price\n")
    assert read_csv(spark, str(empty), VEHICLES).count() == 0
