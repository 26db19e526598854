"""Shared fixtures: one local session, small listing tables, and a scratch table store."""

from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from batchwarden.operators import batching, checks  # noqa: E402
from batchwarden.session import local_session  # noqa: E402
from batchwarden.sources.tables import TableStore  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"
LISTING_DDL = (
    "price double, brand string, model string, year int, mileage double, "
    "title_status string, vin string"
)
FLEET = 7


def fleet_row(i: int) -> list:
    """The i-th listing of a fleet without any fault."""
    make = ("skoda", "seat", "dacia")[i % 3]
    return [2400.0 + 950 * i, make, f"{make}-{i}", 2009 + i, 9000.0 * (i + 1), ("clean", "rebuilt")[i % 2], f"W{i}"]


@pytest.fixture(scope="session")
def spark():
    """A local session with few partitions."""
    return local_session(8, 4)


@pytest.fixture
def clean_df(spark):
    """A fleet without faults."""
    return spark.createDataFrame([tuple(fleet_row(i)) for i in range(FLEET)], LISTING_DDL)


@pytest.fixture
def dirty_df(spark):
    """The fleet with a key held three times, a mileage below zero, a price too high and a make missing."""
    rows = [fleet_row(i) for i in range(FLEET)]
    for i in (3, 5):
        rows[i][6] = "W0"
    rows[4][4] = -1.0
    rows[2][0] = 3.5e6
    rows[6][1] = None
    return spark.createDataFrame([tuple(r) for r in rows], LISTING_DDL)


@pytest.fixture
def store(spark):
    """An empty table store."""
    return TableStore(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp"))


def whole_report(df, profile):
    """The report of a table taken as one batch."""
    return checks.BatchReport(batching.single_batch(df), profile, whole=True)


def result_of(report, name):
    """One check result as a row."""
    return report.results.filter(f"name = '{name}'").first()
