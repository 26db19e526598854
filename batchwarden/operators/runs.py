"""The run history: one record per batch and run."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window, functions as F

from batchwarden.operators.batching import BATCH, PERIOD
from batchwarden.sources.tables import RUNS, TableStore

_STATS = "map<string,struct<mean:double,null_rate:double>>"
_DRIFT = (
    "struct<psi:map<string,double>,null_rate_delta:map<string,double>,"
    "category_shift:map<string,double>,freshness_days:double,alerts:array<string>>"
)

RUN_COLUMNS = {
    "run_id": "string",
    "ts": "timestamp",
    "batch_label": "string",
    "period_start": "timestamp",
    "n_rows": "bigint",
    "dq_pass_rate": "double",
    "n_error_checks": "bigint",
    "freshness_days": "double",
    "n_quarantined": "bigint",
    "halted": "boolean",
    "col_stats": _STATS,
    "drift": _DRIFT,
    "mae": "double",
    "rmse": "double",
    "r2": "double",
    "n_undated": "bigint",
}
RUN_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in RUN_COLUMNS.items())


def run_records(
    verdicts: DataFrame, drift: DataFrame, metrics: DataFrame | None = None, n_undated: int = 0
) -> DataFrame:
    """One record per batch, without id and time; what a halted batch lacks stays empty.

    ``n_undated`` is how many rows of the feed are in no batch, as they have no readable date.
    """
    table = verdicts.join(drift.drop(PERIOD), BATCH, "left")
    if metrics is not None:
        table = table.join(metrics.select(BATCH, "mae", "rmse", "r2"), BATCH, "left")
    else:
        none = F.lit(None).cast("double")
        table = table.withColumns({"mae": none, "rmse": none, "r2": none})
    return table.select(
        F.col(BATCH).alias("batch_label"),
        F.col(PERIOD).alias("period_start"),
        "n_rows",
        "dq_pass_rate",
        "n_error_checks",
        F.coalesce("freshness_days", F.lit(0.0)).alias("freshness_days"),
        "n_quarantined",
        "halted",
        F.col("col_stats").cast(_STATS).alias("col_stats"),
        F.col("drift").cast(_DRIFT).alias("drift"),
        "mae",
        "rmse",
        "r2",
        F.lit(n_undated).cast("bigint").alias("n_undated"),
    )


def stamp_runs(records: DataFrame, started: datetime | None = None) -> DataFrame:
    """Add the run id and time; batches of one run are a microsecond apart, in period order."""
    started = started or datetime.now(timezone.utc)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("period_start")) - 1
    micros = F.lit(int(started.timestamp() * 1_000_000)) + place
    ts = F.timestamp_micros(micros)
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    stamped = records.withColumn("ts", ts)
    stamped = stamped.withColumn("run_id", F.concat_ws("-", "batch_label", text))
    return stamped.select(*RUN_COLUMNS)


def save_runs(store: TableStore, runs: DataFrame, table: str = RUNS, mode: str = "append") -> int:
    """Add run records to the history."""
    return store.write(runs, table, mode)


def load_runs(store: TableStore, table: str = RUNS) -> DataFrame:
    """The run history in time order; empty when there is none yet."""
    return store.read(table, RUN_SCHEMA).orderBy("ts")


def latest_run(runs: DataFrame) -> DataFrame:
    """The most recent run record."""
    return runs.orderBy(F.col("ts").desc(), F.col("period_start").desc()).limit(1)


def previous_run(runs: DataFrame) -> DataFrame:
    """The run a new batch is compared with: the latest one recorded."""
    return latest_run(runs)


def export_json(runs: DataFrame) -> DataFrame:
    """Run records with their nested fields as JSON text."""
    return runs.withColumns({c: F.to_json(c) for c in ("col_stats", "drift")})


def import_json(rows: DataFrame) -> DataFrame:
    """Run records from rows whose nested fields are JSON text."""
    parsed: dict[str, Column] = {
        "col_stats": F.from_json("col_stats", _STATS),
        "drift": F.from_json("drift", _DRIFT),
    }
    return rows.withColumns(parsed)
