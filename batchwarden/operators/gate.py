"""The gate: halt a batch, or set aside exactly the rows the checks condemned."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from batchwarden.operators.batching import BATCH, PERIOD
from batchwarden.operators.checks import BATCH_FATAL, FLAGS, IS_ERROR, BatchReport
from batchwarden.profile import ERROR
from batchwarden.sources.staging import Staged

DISPOSITION = "_disposition"
CLEAN = "clean"
QUARANTINE = "quarantine"


def gate_verdicts(report: BatchReport) -> DataFrame:
    """One verdict per batch.

    A batch halts when a batch-fatal check failed, or when more than the allowed share of its rows
    was named by failed ERROR checks.
    """
    entries = report.entries()
    whole = [F.when(passed, 1).otherwise(0) for _, passed, _, _, _ in entries]
    failed = {name: ~passed & (severity == ERROR) for name, passed, severity, _, _ in entries}
    errors = [F.when(f, 1).otherwise(0) for f in failed.values()]
    ceiling = report.profile.max_error_fraction
    table = report.summary.df.select(
        BATCH,
        PERIOD,
        "n_rows",
        "n_error_rows",
        (reduce(Column.__add__, whole) / len(entries)).alias("dq_pass_rate"),
        reduce(Column.__add__, errors).cast("bigint").alias("n_error_checks"),
        reduce(Column.__or__, [failed[name] for name in BATCH_FATAL]).alias("fatal"),
    )
    share = F.col("n_error_rows") / F.greatest(F.col("n_rows"), F.lit(1))
    over = F.format_string("ERROR-row fraction %.1f%%", F.col("error_fraction") * 100)
    reason = (
        F.when(F.col("fatal"), F.lit("batch-fatal (empty/truncated or missing columns)"))
        .when(F.col("halted"), F.concat(over, F.lit(f" > ceiling {ceiling:.0%}")))
    )
    kept_out = F.when(F.col("halted"), F.lit(0)).otherwise(F.col("n_error_rows"))
    return (
        table
        .withColumn("error_fraction", share)
        .withColumn("halted", F.col("fatal") | (F.col("error_fraction") > ceiling))
        .withColumn("reason", reason)
        .withColumn("n_quarantined", kept_out.cast("bigint"))
    )


def staged_verdicts(report: BatchReport) -> Staged:
    """The verdicts with their known size: a projection of the staged summary."""
    return Staged(gate_verdicts(report), report.summary.rows, report.summary.bytes)


def passing_batches(verdicts: Staged) -> Staged:
    """The verdicts of the batches that were not halted."""
    return Staged(verdicts.df.filter(~F.col("halted")), verdicts.rows, verdicts.bytes)


def dispose(flagged: DataFrame, verdicts: Staged) -> DataFrame:
    """The rows of the batches that passed the gate, each marked clean or quarantined."""
    open_batches = verdicts.side().filter(~F.col("halted")).select(BATCH)
    fate = F.when(F.col(IS_ERROR), F.lit(QUARANTINE)).otherwise(F.lit(CLEAN))
    return flagged.join(open_batches, BATCH, "left_semi").withColumn(DISPOSITION, fate)


def split_clean_quarantine(flagged: DataFrame, verdicts: Staged) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and quarantined rows with the checks that named them."""
    rows = dispose(flagged, verdicts)
    clean = rows.filter(~F.col(IS_ERROR)).drop(FLAGS, IS_ERROR, DISPOSITION)
    return clean, rows.filter(F.col(IS_ERROR)).drop(IS_ERROR, DISPOSITION)


def catch_rate(runs: DataFrame) -> DataFrame:
    """Quarantined rows over all rows of the recorded runs."""
    totals = runs.agg(
        F.coalesce(F.sum("n_quarantined"), F.lit(0)).alias("n_quarantined"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
    )
    rate = F.coalesce(F.try_divide(F.col("n_quarantined"), F.col("n_rows")), F.lit(0.0))
    return totals.withColumn("catch_rate", rate)


def any_halted(verdicts: DataFrame) -> bool:
    """Exit status of a backfill: whether any batch was halted."""
    return bool(verdicts.agg(F.bool_or("halted")).first()[0])
