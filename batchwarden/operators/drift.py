"""Drift and freshness of each clean batch against the previous passing one.

All pairs are handled in one plan.  Rows are reduced to one row of counts per batch; the previous
batch's figures are then read with ``lag`` over those few rows, never by joining rows to rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from batchwarden.functions.coerce import is_missing, to_number, to_utc_timestamp
from batchwarden.operators.batching import BATCH, PERIOD, source_columns
from batchwarden.operators.quantiles import exact_percentiles
from batchwarden.profile import TableProfile
from batchwarden.sources.staging import Staged, stage

PREVIOUS = "_previous"

# Fixed value: added to every share so that an empty bin has a logarithm.
SHARE_FLOOR = 1e-6

_MICROS_PER_DAY = 86_400_000_000


def _in_order() -> Window:
    """Chronological order of the batches; only ever used over one row per batch."""
    return Window.partitionBy(F.lit(0)).orderBy(PERIOD)


def _number(df: DataFrame, name: str) -> Column:
    return to_number(F.col(name), df.schema[name].dataType)


def previous_batches(passing: DataFrame) -> DataFrame:
    """Each passing batch with the passing batch before it (NULL for the first)."""
    pairs = passing.select(BATCH, PERIOD)
    return pairs.withColumn(PREVIOUS, F.lag(BATCH).over(_in_order()))


def _present(df: DataFrame, columns) -> list[str]:
    return [c for c in columns if c in df.columns]


def psi_by_batch(
    clean: DataFrame, passing: Staged, columns: list[str], bins: int
) -> DataFrame:
    """Population stability index of each column against the previous passing batch.

    Every row is compared with the bin edges of its own batch (where it is the expected side) and
    of the previous batch (where it is the actual side); both are cumulative counts of one
    aggregation.  The columns are ``psi_<name>``, NULL for the first batch.
    """
    columns = _present(clean, columns)
    shares = [i / bins for i in range(bins + 1)]
    numbers = {c: _number(clean, c) for c in columns}
    edges = exact_percentiles(
        clean, [BATCH], {f"edges_{c}": numbers[c] for c in columns}, shares
    )
    edges = stage(passing.df.select(BATCH, PERIOD).join(edges, BATCH, "left"), "edges")

    # Inner edges: those equal to the lowest edge bound no bin, those equal to the highest are
    # never reached.
    both_sides = edges.df.select(
        BATCH,
        *[F.col(f"edges_{c}").alias(f"own_{c}") for c in columns],
        *[F.lag(f"edges_{c}").over(_in_order()).alias(f"past_{c}") for c in columns],
    )
    places = [(s, c, i) for c in columns for s in ("own", "past") for i in range(1, bins)]
    cuts = both_sides.selectExpr(
        BATCH,
        *[
            f"CASE WHEN `{s}_{c}`[{i}] <= `{s}_{c}`[0] THEN double('-Infinity') "
            f"WHEN `{s}_{c}`[{i}] < `{s}_{c}`[{bins}] THEN `{s}_{c}`[{i}] END AS `{s}_{c}_{i}`"
            for s, c, i in places
        ],
    )
    cuts = F.broadcast(cuts) if edges.fits else cuts

    values = clean.select(BATCH, *[numbers[c].alias(f"v_{c}") for c in columns])
    totals = [F.expr(f"count(`v_{c}`)").alias(f"n_{c}") for c in columns]
    reached = [F.expr(f"count_if(`v_{c}` >= `{s}_{c}_{i}`)").alias(f"{s}_{c}_{i}") for s, c, i in places]
    counts = values.join(cuts, BATCH).groupBy(BATCH).agg(*totals, *reached)

    # From here on one row per batch: both sides' counts as arrays, the previous batch's by lag.
    def steps(side: str, column: str) -> str:
        return ", ".join(f"`{side}_{column}_{i}`" for i in range(1, bins))

    table = edges.df.join(counts, BATCH, "left").selectExpr(
        BATCH,
        PERIOD,
        *[f"coalesce(`n_{c}`, 0) AS `n_{c}`" for c in columns],
        *[f"array({steps('past', c)}) AS `actual_{c}`" for c in columns],
        *[
            f"lag(struct(coalesce(`n_{c}`, 0) AS n, array({steps('own', c)}) AS steps, "
            f"`edges_{c}`[0] AS low, `edges_{c}`[{bins}] AS high)) "
            f"OVER (PARTITION BY 0 ORDER BY {PERIOD}) AS `before_{c}`"
            for c in columns
        ],
    )
    return table.selectExpr(BATCH, PERIOD, *[f"{_psi(c)} AS `psi_{c}`" for c in columns])


def _psi(column: str) -> str:
    """SQL text: the index of one column from the cumulative counts of both sides."""

    def shares(total: str, steps: str) -> str:
        upper, lower = f"concat(array({total}), {steps})", f"concat({steps}, array(0L))"
        return f"zip_with({upper}, {lower}, (x, y) -> (x - y) / {total} + {SHARE_FLOOR!r}D)"

    before, n = f"`before_{column}`", f"`n_{column}`"
    actual = shares(n, f"`actual_{column}`")
    expected = shares(f"{before}.n", f"{before}.steps")
    terms = f"zip_with({actual}, {expected}, (a, e) -> (a - e) * ln(a / e))"
    return (
        f"CASE WHEN {before} IS NULL THEN NULL "
        f"WHEN {before}.n = 0 OR {n} = 0 OR {before}.low = {before}.high THEN 0D "
        f"ELSE aggregate({terms}, 0D, (s, t) -> s + t) END"
    )


def batch_statistics(clean: DataFrame, passing: Staged, profile: TableProfile) -> DataFrame:
    """One row per passing batch: size, empty share of every column, means, and newest date."""
    columns = source_columns(clean)
    empty = {c: is_missing(F.col(c), clean.schema[c].dataType) for c in columns}
    aggregates = [F.count(F.lit(1)).alias("n_clean")]
    aggregates += [F.avg(empty[c].cast("int")).alias(f"null_{c}") for c in columns]
    key_columns = _present(clean, profile.drift.psi_columns)
    aggregates += [F.avg(_number(clean, c)).alias(f"mean_{c}") for c in key_columns]
    categories = _present(clean, profile.drift.category_columns)
    aggregates += [F.count(c).alias(f"given_{c}") for c in categories]
    stamp = F.lit(None).cast("timestamp")
    if profile.date_column in clean.columns:
        dtype = clean.schema[profile.date_column].dataType
        stamp = to_utc_timestamp(F.col(profile.date_column), dtype)
    aggregates.append(F.max(stamp).alias("newest"))
    stats = passing.df.select(BATCH, PERIOD).join(
        clean.groupBy(BATCH).agg(*aggregates), BATCH, "left"
    )
    filled = ["n_clean"] + [f"null_{c}" for c in columns] + [f"given_{c}" for c in categories]
    stats = stats.fillna(0, filled)
    return stats.withColumn("freshness_days", freshness(F.col("newest"), profile))


def freshness(newest: Column, profile: TableProfile) -> Column:
    """Whole days from the newest date to the reference date, rounded down; 0 without either."""
    if profile.drift.reference_date is None:
        return F.lit(0.0)
    reference = F.lit(profile.drift.reference_date).cast("timestamp")
    micros = F.unix_micros(reference) - F.unix_micros(newest)
    days = F.floor(micros / F.lit(_MICROS_PER_DAY)).cast("double")
    return F.coalesce(days, F.lit(0.0))


def null_rate_deltas(statistics: DataFrame, columns: list[str]) -> DataFrame:
    """Change in the empty share of each column since the previous passing batch."""
    deltas = [
        (F.col(f"null_{c}") - F.lag(f"null_{c}").over(_in_order())).alias(f"delta_{c}")
        for c in columns
    ]
    return statistics.select(BATCH, PERIOD, *deltas)


def category_shift_by_batch(
    clean: DataFrame, statistics: Staged, columns: list[str]
) -> DataFrame:
    """Largest change of any category's share since the previous passing batch, per column.

    Each category count is sent once to its own batch and once to the batch after, where the two
    shares meet in one aggregation; a frequent category is already a single row by then.
    """
    columns = _present(clean, columns)
    known = statistics.df.select(
        BATCH,
        PERIOD,
        F.lag(BATCH).over(_in_order()).alias(PREVIOUS),
        F.lead(BATCH).over(_in_order()).alias("_next"),
        *[f"given_{c}" for c in columns],
    )
    pairs = F.broadcast(known) if statistics.fits else known
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    counts = (
        clean.select(BATCH, F.inline(F.array(*entries)))
        .filter(F.col("value").isNotNull())
        .groupBy(BATCH, "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    given = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(f"given_{c}"))])
    shares = counts.join(pairs, BATCH).withColumn("share", F.col("n") / given[F.col("column")])
    share, none = F.col("share"), F.lit(0.0)
    as_current = F.when(
        F.col(PREVIOUS).isNotNull(),
        F.struct(F.col(BATCH).alias("pair"), share.alias("now"), none.alias("then")),
    )
    as_previous = F.when(
        F.col("_next").isNotNull(),
        F.struct(F.col("_next").alias("pair"), none.alias("now"), share.alias("then")),
    )
    change = F.abs(F.sum("now") - F.sum("then")).alias("change")
    changes = (
        shares.select("column", "value", F.inline(F.array_compact(F.array(as_current, as_previous))))
        .groupBy("pair", "column", "value")
        .agg(change)
    )
    largest = [
        F.max(F.when(F.col("column") == c, F.col("change"))).alias(f"shift_{c}") for c in columns
    ]
    shifts = changes.groupBy("pair").agg(*largest).withColumnRenamed("pair", BATCH)
    table = known.select(BATCH, PERIOD, PREVIOUS).join(shifts, BATCH, "left")
    filled = [
        F.when(F.col(PREVIOUS).isNotNull(), F.coalesce(F.col(f"shift_{c}"), none)).alias(f"shift_{c}")
        for c in columns
    ]
    return table.select(BATCH, PERIOD, *filled)


def _named(prefix: str, columns: list[str]) -> Column:
    """A map from column name to the value of ``<prefix>_<name>``."""
    if not columns:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    return F.create_map(*[x for c in columns for x in (F.lit(c), F.col(f"{prefix}_{c}"))])


def drift_alerts(profile: TableProfile, columns: dict[str, list[str]]) -> Column:
    """Alert texts of a batch, in signal order; every threshold is exclusive."""
    d = profile.drift
    alerts = []
    for c in columns["psi"]:
        value = F.col(f"psi_{c}")
        text = F.format_string(f"PSI drift on {c}: %.3f > {d.psi_alert}", value)
        alerts.append(F.when(value > d.psi_alert, text))
    for c in columns["delta"]:
        value = F.col(f"delta_{c}")
        text = F.format_string(f"null-rate drift on {c}: %+.3f", value)
        alerts.append(F.when(F.abs(value) > d.null_rate_alert, text))
    for c in columns["shift"]:
        value = F.col(f"shift_{c}")
        text = F.format_string(f"category shift on {c}: %.3f > {d.category_alert}", value)
        alerts.append(F.when(value > d.category_alert, text))
    if d.reference_date is not None:
        days = F.col("freshness_days")
        text = F.format_string(
            f"stale data: newest {profile.date_column} %.0fd old > {d.max_staleness_days:.0f}d",
            days,
        )
        alerts.append(F.when(days > d.max_staleness_days, text))
    return F.array_compact(F.array(*alerts).cast("array<string>"))


def compute_drift(
    clean: DataFrame,
    passing: Staged,
    profile: TableProfile,
    statistics: Staged | None = None,
) -> DataFrame:
    """One row per passing batch: freshness, statistics and the drift record.

    ``drift`` is NULL for the first batch, which has nothing to be compared with.
    """
    d = profile.drift
    statistics = statistics or stage(batch_statistics(clean, passing, profile), "statistics")
    columns = {
        "psi": _present(clean, d.psi_columns),
        "delta": source_columns(clean),
        "shift": _present(clean, d.category_columns),
    }
    table = statistics.df.join(previous_batches(statistics.df).select(BATCH, PREVIOUS), BATCH)
    table = table.join(null_rate_deltas(statistics.df, columns["delta"]).drop(PERIOD), BATCH)
    if columns["psi"]:
        values = psi_by_batch(clean, passing, columns["psi"], d.psi_bins)
        table = table.join(values.drop(PERIOD), BATCH)
    if columns["shift"]:
        shifts = category_shift_by_batch(clean, statistics, columns["shift"])
        table = table.join(shifts.drop(PERIOD), BATCH)
    record = F.struct(
        _named("psi", columns["psi"]).alias("psi"),
        _named("delta", columns["delta"]).alias("null_rate_delta"),
        _named("shift", columns["shift"]).alias("category_shift"),
        F.col("freshness_days"),
        drift_alerts(profile, columns).alias("alerts"),
    )
    stats = F.create_map(
        *[
            x
            for c in columns["psi"]
            for x in (
                F.lit(c),
                F.struct(F.col(f"mean_{c}").alias("mean"), F.col(f"null_{c}").alias("null_rate")),
            )
        ]
    ) if columns["psi"] else F.lit(None)
    return table.select(
        BATCH,
        PERIOD,
        PREVIOUS,
        "n_clean",
        "freshness_days",
        stats.alias("col_stats"),
        F.when(F.col(PREVIOUS).isNotNull(), record).alias("drift"),
    )


def has_alert(drift: Column) -> Column:
    """Whether a drift record raised any alert."""
    return F.coalesce(F.size(drift["alerts"]) > 0, F.lit(False))
