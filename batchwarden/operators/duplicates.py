"""Duplicate rows and repeated keys within a batch.

Copies are counted by aggregation, which folds them together before the shuffle, so a key or a row
that fills a third of the table never gathers in one task.  Only the list of repeated keys is then
matched back to the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from batchwarden.operators.batching import BATCH, source_columns
from batchwarden.operators.membership import mark_members
from batchwarden.sources.staging import Staged, measured, stage

FINGERPRINT = "_fingerprint"
REPEATED_KEY = "_repeated_key"
COPIED_ROW = "_copied_row"
SUSPECT = "_suspect_key"


def fingerprint(df: DataFrame, columns: list[str]) -> Column:
    """64-bit hash over the columns; equal rows have equal hashes, with -0.0 equal to 0.0."""
    values = []
    for name in columns:
        value = F.col(name)
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            value = value + F.lit(0.0)
        values.append(value)
    return F.xxhash64(*values)


@dataclass(frozen=True)
class Duplicates:
    """Repeated keys (batch, key, n) and fully repeated rows (batch, fingerprint, columns, n).

    Either is None where nothing can be repeated.
    """

    key: str | None
    columns: list[str]
    keys: Staged | None
    rows: Staged | None

    def copies_per_batch(self) -> DataFrame | None:
        """Number of fully duplicated rows per batch."""
        if self.rows is None:
            return None
        return self.rows.df.groupBy(BATCH).agg(F.sum("n").alias("n_copies"))


def suspicious() -> Column:
    """Whether two of a key's rows may be equal: always among three, of two only with one fingerprint."""
    return ((F.count(F.lit(1)) > 2) | (F.min(FINGERPRINT) == F.max(FINGERPRINT))).alias(SUSPECT)


def key_counts(batched: DataFrame, key: str, *more: Column) -> DataFrame:
    """Rows per key met more than once within a batch, and rows without a key, with further aggregates."""
    counts = batched.groupBy(BATCH, key).agg(F.count(F.lit(1)).alias("n"), *more)
    return counts.filter((F.col("n") > 1) | F.col(key).isNull())


def repeated_keys(batched: DataFrame, key: str) -> DataFrame:
    """Keys met more than once within a batch; rows without a key are no duplicates."""
    return key_counts(batched.filter(F.col(key).isNotNull()), key)


def copied_rows(batched: DataFrame, columns: list[str]) -> Staged:
    """Rows equal on every column to another row of their batch, each once, with their count.

    Fingerprints are counted first; whole rows are compared only where a fingerprint repeats.
    """
    printed = batched.withColumn(FINGERPRINT, fingerprint(batched, columns))
    counts = printed.groupBy(BATCH, FINGERPRINT).agg(F.count(F.lit(1)).alias("n"))
    suspects = stage(counts.filter(F.col("n") > 1), "fingerprints")
    if suspects.rows == 0:
        return suspects
    printed = mark_members(printed, suspects, [BATCH, FINGERPRINT], "_suspect").filter("_suspect").drop("_suspect")
    exact = printed.groupBy(BATCH, FINGERPRINT, *columns).agg(F.count(F.lit(1)).alias("n"))
    return stage(exact.filter(F.col("n") > 1), "copied-rows")


def find_duplicates(batched: DataFrame, key: str | None) -> Duplicates:
    """Count and stage the repeated keys and the fully repeated rows of every batch.

    Copies of a row repeat its key, if it has one.  So whole rows are only looked at where the key
    is repeated or missing, and not at all in a table where every row has a key of its own. Two rows
    of a key that differ in their fingerprints are told apart while keys are counted.
    """
    columns = source_columns(batched)
    if key not in columns:
        return Duplicates(None, columns, None, copied_rows(batched, columns))
    # Maps have no hash; with them every repeated key is suspect.
    hashed = not any(kind in batched.schema[c].dataType.simpleString() for c in columns for kind in ("map<", "variant"))
    printed = batched.withColumn(FINGERPRINT, fingerprint(batched, columns) if hashed else F.lit(0))
    counts = stage(key_counts(printed, key, suspicious()), "repeated-keys")
    if counts.rows == 0:
        return Duplicates(key, columns, None, None)
    keys = Staged(counts.df.filter(F.col(key).isNotNull()), counts.rows, counts.bytes)
    suspects = measured(keys.df.filter(SUSPECT))
    candidates = mark_members(batched, suspects, [BATCH, key], REPEATED_KEY)
    candidates = candidates.filter(F.col(REPEATED_KEY) | F.col(key).isNull()).drop(REPEATED_KEY)
    return Duplicates(key, columns, keys, copied_rows(candidates, columns))


def mark_duplicates(batched: DataFrame, found: Duplicates) -> DataFrame:
    """Flag every copy: rows with a repeated key, and rows repeated as a whole.

    A copied row that has a key also repeats that key, so whole rows are matched only where the
    key is missing.
    """
    rows = batched
    if found.keys is None:
        rows = rows.withColumn(REPEATED_KEY, F.lit(False))
    else:
        rows = mark_members(rows, found.keys, [BATCH, found.key], REPEATED_KEY)
    if found.rows is None or found.rows.rows == 0:
        return rows.withColumn(COPIED_ROW, F.lit(False))
    printed = fingerprint(batched, found.columns)
    members = found.rows
    if found.key is not None:
        keyless = members.df.filter(F.col(found.key).isNull())
        members = stage(keyless, "copied-keyless-rows")
        printed = F.when(F.col(found.key).isNull(), printed)
    rows = rows.withColumn(FINGERPRINT, printed)
    rows = mark_members(rows, members, [BATCH, FINGERPRINT], COPIED_ROW, found.columns)
    return rows.drop(FINGERPRINT)
