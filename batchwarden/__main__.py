"""Command line: run the pipeline, validate a feed, or load it only if it is sound.

    python -m batchwarden run INPUT --out FOLDER [--backfill] [--no-train]
    python -m batchwarden validate INPUT
    python -m batchwarden load INPUT --out FOLDER --table NAME

INPUT is a CSV file (by its ending) or a parquet table.  Exit status 1 means a halted batch or a
failed check.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from batchwarden.operators.checks import summary_lines
from batchwarden.plans.pipeline import passes, run_batches, strict_load, validate
from batchwarden.profiles import EVENTS, LISTINGS, VEHICLES
from batchwarden.session import configure
from batchwarden.sources.csv import coerce_types, normalise_headers, read_csv
from batchwarden.sources.staging import stage
from batchwarden.sources.tables import TableStore

PROFILES = {p.name: p for p in (VEHICLES, LISTINGS, EVENTS)}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="batchwarden")
    parser.add_argument("command", choices=("run", "validate", "load"))
    parser.add_argument("input")
    parser.add_argument("--profile", choices=sorted(PROFILES), default=VEHICLES.name)
    parser.add_argument("--out", help="folder of the result tables")
    parser.add_argument("--table", default="clean_feed", help="table replaced by load")
    parser.add_argument("--backfill", action="store_true", help="one run per calendar batch")
    parser.add_argument("--no-train", action="store_true", help="skip model fitting")
    parser.add_argument("--split-lines", action="store_true", help="CSV without quoted line breaks")
    parser.add_argument("--max-error-fraction", type=float)
    parser.add_argument("--reference-date")
    arguments = parser.parse_args(argv)
    if arguments.command != "validate" and not arguments.out:
        parser.error("--out is required")
    return arguments


def _profile(arguments: argparse.Namespace):
    profile = PROFILES[arguments.profile]
    if arguments.max_error_fraction is not None:
        profile = profile.but(max_error_fraction=arguments.max_error_fraction)
    if arguments.reference_date is not None:
        profile = profile.with_drift(reference_date=arguments.reference_date)
    return profile


def _read(spark: SparkSession, arguments: argparse.Namespace, profile) -> DataFrame:
    """The typed feed; a CSV feed is parsed once and kept as a staged table."""
    if arguments.input.lower().endswith((".csv", ".csv.gz")):
        feed = read_csv(spark, arguments.input, profile, multi_line=False if arguments.split_lines else None)
        return stage(feed, "feed").df
    raw = normalise_headers(spark.read.parquet(arguments.input), profile.column_map)
    return coerce_types(raw, profile)


def main(argv: list[str] | None = None) -> int:
    """Run one command and return the exit status."""
    arguments = _arguments(argv)
    spark = configure(SparkSession.builder.appName("batchwarden").getOrCreate())
    profile = _profile(arguments)
    feed = _read(spark, arguments, profile)
    if arguments.command == "validate":
        report = validate(feed, profile)
        for row in summary_lines(report.results).orderBy("position").collect():
            print(row["line"])
        return 0 if passes(report) else 1
    store = TableStore(spark, arguments.out)
    if arguments.command == "load":
        rows = strict_load(feed, profile, store, arguments.table)
        print("refused: failed ERROR checks" if rows is None else f"loaded {rows} rows")
        return 1 if rows is None else 0
    result = run_batches(feed, profile, store, arguments.backfill, not arguments.no_train)
    columns = ("batch_label", "n_rows", "dq_pass_rate", "n_quarantined", "halted", "mae")
    result.runs.orderBy("ts").select(*columns).show(100, truncate=False)
    return 1 if result.halted else 0


if __name__ == "__main__":
    sys.exit(main())
