"""Ready-made profiles: vehicle listings (the default feed) and the two test-data tables."""

from __future__ import annotations

from batchwarden.profile import (
    ColumnRule,
    ConsistencyRule,
    DriftSettings,
    TableProfile,
)

# Defaults of the vehicle-listing feed.
LISTING_COLUMN_MAP = {"manufacturer": "brand", "odometer": "mileage"}
LISTING_REQUIRED = ("price", "brand", "model", "year", "mileage")
LISTING_RANGES = {
    "price": (1, 1000000),
    "year": (1950, 2027),
    "mileage": (0, 1000000),
}
LISTING_NULL_FRACTION_MAX = {
    "price": 0.0,
    "brand": 0.05,
    "model": 0.10,
    "year": 0.02,
    "mileage": 0.20,
}
LISTING_TITLE_STATUS = ("clean", "salvage", "rebuilt", "lien", "missing", "parts only")
LISTING_FRESH_CONDITIONS = ("new", "like new")
LISTING_MAX_FRESH_MILEAGE = 60000
REFERENCE_DATE = "2024-03-01"

LISTING_SCHEMA = (
    ColumnRule("price", "double"),
    ColumnRule("brand", "string"),
    ColumnRule("model", "string", nullable=True),
    ColumnRule("year", "int"),
    ColumnRule("mileage", "double", nullable=True),
)

VEHICLES = TableProfile(
    name="vehicles",
    date_column="posting_date",
    required=LISTING_REQUIRED,
    key="vin",
    schema=LISTING_SCHEMA,
    ranges=LISTING_RANGES,
    null_fraction_max=LISTING_NULL_FRACTION_MAX,
    category_column="title_status",
    known_values=LISTING_TITLE_STATUS,
    consistency=ConsistencyRule(
        "condition", LISTING_FRESH_CONDITIONS, "mileage", LISTING_MAX_FRESH_MILEAGE
    ),
    drift=DriftSettings(
        psi_columns=("price", "mileage", "year"),
        category_columns=("title_status", "brand"),
        reference_date=REFERENCE_DATE,
    ),
    target="price",
    numeric=("year", "mileage"),
    categorical=("brand", "model", "condition", "state"),
    column_map=LISTING_COLUMN_MAP,
)

LISTINGS = VEHICLES.but(
    name="listings",
    freq="Q",
    known_values=("A", "N"),
    consistency=ConsistencyRule("condition", ("PROMO",), "mileage", 60000),
)

EVENTS = TableProfile(
    name="events",
    date_column="ts",
    required=("event_id", "ts", "user_id", "event_type", "value"),
    key="event_id",
    schema=(
        ColumnRule("event_id", "int"),
        ColumnRule("user_id", "int"),
        ColumnRule("event_type", "string"),
        ColumnRule("value", "double", nullable=True),
    ),
    ranges={"value": (1, 200)},
    null_fraction_max={"value": 0.05, "event_type": 0.0},
    category_column="event_type",
    known_values=("click", "error", "purchase", "signup", "view"),
    drift=DriftSettings(
        psi_columns=("value",),
        category_columns=("event_type",),
        reference_date=REFERENCE_DATE,
    ),
    target="value",
    numeric=("user_id",),
    categorical=("event_type",),
)
