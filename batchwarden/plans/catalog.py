"""The registered queries: every operator over whole test tables.

Each query takes a session and a folder of parquet tables and returns a DataFrame.  Dates leave as
text and per-batch doubles rounded, so that results can be compared between engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from batchwarden.operators import (
    batching,
    checks,
    drift,
    duplicates,
    features,
    gate,
    inject,
    metrics,
    models,
    runs,
    views,
)
from batchwarden.operators.batching import BATCH, PERIOD
from batchwarden.plans.pipeline import passes, run_batches, strict_load, validate
from batchwarden.profile import ModelSettings, TableProfile
from batchwarden.profiles import EVENTS, LISTINGS
from batchwarden.session import configure, shared_folder
from batchwarden.sources import testdata
from batchwarden.sources.csv import coerce_types, normalise_headers, read_csv
from batchwarden.sources.staging import Staged, stage
from batchwarden.sources.tables import TableStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Settings shared with the comparison SQL.
BAD_FRACTION = 0.06
STALE_ANCHOR = "1995-01-01"
FIRST_PERIOD = "1995-01-01"
STRICT_CEILING = 0.44
TOLERANT_BRAND = 0.01
DEFECT_CEILING = 0.9
SHOCK = inject.DriftSpec(shock_period=14, shock_multiplier=1.5)
TREND = inject.DriftSpec(
    inflation=0.015,
    shock_period=14,
    shock_multiplier=1.5,
    rising_null_column="mileage",
    new_category_period=10,
)
COPY_SHARE = 50
KEYLESS_SHARE = 25

STRICT = LISTINGS.but(key="vin_strict", max_error_fraction=STRICT_CEILING)
TRENDING = STRICT.but(null_fraction_max={**LISTINGS.null_fraction_max, "mileage": 0.90})
DEFECTIVE = LISTINGS.but(max_error_fraction=DEFECT_CEILING)
# The forest is cut in queries: 200 trees of depth 16 take longer than a query may (figures in the README).
SMALL_FOREST = ModelSettings(forest_trees=6, forest_depth=5)


def query(function: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


# ------------------------------------------------------------------------------------ inputs


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings written once, since the checks read them several times."""
    return stage(testdata.listings(spark, sf_dir), "listings").df


def _row_key() -> Column:
    return F.concat_ws("|", "vin", "model", "state")


def _defective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with injected defects."""
    rows = testdata.listings(spark, sf_dir)
    hit = inject.inject_defects(rows, _row_key(), BAD_FRACTION, STALE_ANCHOR)
    return stage(hit, "defective-listings").df


def _drifting(spark: SparkSession, sf_dir: str, spec: inject.DriftSpec) -> DataFrame:
    """Listings with injected drift."""
    rows = testdata.listings(spark, sf_dir)
    changed = inject.inject_drift(rows, _row_key(), spec, "Q", FIRST_PERIOD)
    return stage(changed, "drifting-listings").df


def _report(df: DataFrame, profile: TableProfile) -> checks.BatchReport:
    return checks.BatchReport(batching.assign_batches(df, profile), profile)


def _passed(df: DataFrame, profile: TableProfile) -> tuple[DataFrame, Staged, Staged]:
    """Clean rows, verdicts and passing batches."""
    report = _report(df, profile).store()
    verdicts = gate.staged_verdicts(report)
    clean, _ = gate.split_clean_quarantine(report.flagged, verdicts)
    return clean, verdicts, gate.passing_batches(verdicts)


def _date(column: str = PERIOD) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias("period_start")


def _round(column: Column | str, name: str | None = None) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, 6).alias(name) if name else F.round(column, 6)


def _store(spark: SparkSession) -> TableStore:
    return TableStore(spark, f"{shared_folder(spark)}/batchwarden/store-{uuid.uuid4().hex}")


# ---------------------------------------------------------------------------------- batching


def _counts(df: DataFrame, profile: TableProfile) -> DataFrame:
    counts = batching.batch_counts(batching.assign_batches(df, profile), profile.min_batch_rows)
    return counts.select(BATCH, _date(), F.col("position").cast("int").alias("position"), "n_rows", "kept")


@query
def batch_counts_weekly(spark, sf_dir):
    return _counts(testdata.events(spark, sf_dir), EVENTS)


@query
def batch_counts_quarterly(spark, sf_dir):
    return _counts(testdata.listings(spark, sf_dir), LISTINGS)


@query
def batch_counts_daily(spark, sf_dir):
    return _counts(testdata.events(spark, sf_dir), EVENTS.but(freq="D", min_batch_rows=20))


@query
def batch_counts_monthly(spark, sf_dir):
    return _counts(testdata.listings(spark, sf_dir), LISTINGS.but(freq="M"))


@query
def batch_counts_yearly(spark, sf_dir):
    return _counts(testdata.listings(spark, sf_dir), LISTINGS.but(freq="Y"))


@query
def kept_batch_rows(spark, sf_dir):
    batched = batching.assign_batches(testdata.events(spark, sf_dir), EVENTS)
    kept = batching.drop_small_batches(batched, 700)
    return kept.select("event_id", BATCH, _date())


@query
def undated_rows(spark, sf_dir):
    texts = _event_texts(spark, sf_dir)
    return batching.undated_rows(texts, EVENTS)


# ------------------------------------------------------------------------ scans and coercion


def _event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a text feed: some numbers and dates unreadable, some dates with an offset."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = F.col("event_id")
    number = F.col("value").cast("string")
    value = (
        F.when(n % 7 == 0, F.lit("abc"))
        .when(n % 11 == 0, F.lit("1d"))
        .when(n % 13 == 0, F.concat(F.lit("  "), number, F.lit(" ")))
        .when(n % 17 == 0, F.lit("n/a"))
        .otherwise(number)
    )
    second = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    ts = (
        F.when(n % 19 == 0, F.lit("not-a-date"))
        .when(n % 5 == 0, F.concat(second, F.lit("+02:00")))
        .when(n % 3 == 0, F.concat(second, F.lit("-0500")))
        .otherwise(second)
    )
    return raw.select(n.alias("event_id"), value.alias("value"), ts.alias("ts"), "event_type")


@query
def coerce_numeric_timestamp(spark, sf_dir):
    typed = coerce_types(_event_texts(spark, sf_dir), EVENTS)
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts")
    return typed.select("event_id", "value", stamp, "event_type")


def _rendered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose dates are written in eight ways, or not at all."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = F.col("event_id") % 10
    ways = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy", "MMMM d, yyyy", "yyyy-MM-dd h:mm a", "M/d/yyyy H:mm", "MMM d, yyyy", "yyyyMMdd"]
    text = F.when(n == 8, F.lit("some day"))
    for i, way in enumerate(ways):
        text = text.when(n == i, F.date_format("ts", way))
    return raw.select("event_id", text.alias("ts"))


@query
def date_renderings(spark, sf_dir):
    typed = coerce_types(_rendered_events(spark, sf_dir), EVENTS)
    return typed.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query
def date_format_counts(spark, sf_dir):
    return batching.date_formats(_rendered_events(spark, sf_dir), EVENTS)


@query
def header_normalisation(spark, sf_dir):
    raw = spark.read.parquet(f"{sf_dir}/part.parquet")
    shown = raw.select(
        F.col("p_partkey").alias(" Part "),
        F.col("p_brand").alias("Manufacturer"),
        F.col("p_retailprice").alias("ODOMETER "),
    )
    return normalise_headers(shown, LISTINGS.column_map)


@query
def csv_scan_mapped(spark, sf_dir):
    path = f"{shared_folder(spark)}/batchwarden/csv-{uuid.uuid4().hex}"
    texts = _event_texts(spark, sf_dir).select(
        F.col("event_id").alias("Event_ID"),
        F.col("value").alias(" Amount"),
        F.col("ts").alias("When "),
        F.concat(F.col("event_type"), F.lit(',\n"x"')).alias("event_type"),
    )
    texts.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    typed = read_csv(spark, path, EVENTS, {"Amount": "value", "WHEN": "ts"})
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts")
    return typed.select(F.col("event_id").cast("bigint").alias("event_id"), "value", stamp, "event_type")


@query
def read_by_sql(spark, sf_dir):
    store = _store(spark)
    store.write(testdata.events(spark, sf_dir), "events_copy")
    text = (
        "SELECT event_type, count(*) AS n_rows, round(sum(value), 4) AS total "
        "FROM events_copy WHERE value > 50 GROUP BY event_type"
    )
    return store.query(text, ("events_copy",))


@query
def table_write_append(spark, sf_dir):
    store = _store(spark)
    rows = testdata.events(spark, sf_dir).select("event_id", "event_type")
    first = store.write(rows, "t", "overwrite")
    second = store.write(rows, "t", "append")
    counts = store.read("t").groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("n_written", F.lit(first + second).cast("bigint"))


@query
def table_refresh(spark, sf_dir):
    store = _store(spark)
    rows = batching.assign_batches(testdata.events(spark, sf_dir), EVENTS)
    rows = rows.select("event_id", BATCH)
    store.write(rows, "t", "refresh", (BATCH,))
    last = rows.filter(F.col(BATCH) == "2024-W02").withColumn("event_id", -F.col("event_id"))
    store.write(last, "t", "refresh", (BATCH,))
    return store.read("t").select("event_id", BATCH)


@query
def strict_gate_load(spark, sf_dir):
    store = _store(spark)
    rows = testdata.events(spark, sf_dir)
    refused = strict_load(rows, EVENTS, store, "refused")
    ranges = {"value": (0, 1000000000)}
    loaded = strict_load(rows, EVENTS.but(ranges=ranges), store, "loaded")
    table = store.read("loaded").groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))
    return table.withColumns(
        {
            "refused": F.lit(refused is None and not store.exists("refused")),
            "n_loaded": F.lit(loaded).cast("bigint"),
        }
    )


# ------------------------------------------------------------------------------------ checks


def _kept_rules(df: DataFrame, profile: TableProfile):
    report = _report(df, profile)
    return report.kept, report.rules


@query
def schema_failures(spark, sf_dir):
    rows, rules = _kept_rules(_defective(spark, sf_dir), LISTINGS)
    failures = rows.withColumn("f", rules.schema_failures()).groupBy(BATCH)
    return failures.agg(
        F.sum("f").cast("bigint").alias("n_failures"), F.count_if(F.col("f") > 0).alias("n_rows")
    )


@query
def range_violations(spark, sf_dir):
    rows, rules = _kept_rules(_defective(spark, sf_dir), LISTINGS)
    return rows.groupBy(BATCH).agg(
        F.count_if(rules.any_out_of_range()).alias("n_rows"),
        *[F.count_if(rules.out_of_range(c)).alias(f"n_{c}") for c in ("price", "year", "mileage")],
    )


def _null_policy(df: DataFrame, limits: dict[str, float]) -> DataFrame:
    results = _report(df, LISTINGS.but(null_fraction_max=limits)).results
    found = results.filter(F.col("name") == checks.NULLS)
    return found.select(BATCH, "passed", "severity", "n_violations", "detail")


@query
def null_policy(spark, sf_dir):
    limits = {"price": 0.0, "brand": TOLERANT_BRAND, "mileage": 0.2}
    return _null_policy(_defective(spark, sf_dir), limits)


@query
def null_policy_escalated(spark, sf_dir):
    return _null_policy(_defective(spark, sf_dir), {"brand": 0.0, "mileage": 0.2})


@query
def duplicate_keys(spark, sf_dir):
    rows, _ = _kept_rules(_listings(spark, sf_dir), LISTINGS)
    return duplicates.repeated_keys(rows, "vin")


@query
def duplicate_rows(spark, sf_dir):
    rows = testdata.listings(spark, sf_dir)
    draw = inject.hash32("dup", _row_key()) % 1000
    copies = rows.filter(draw < COPY_SHARE)
    keyless = F.when(draw >= KEYLESS_SHARE, F.col("vin")).alias("vin")
    both = rows.unionByName(copies)
    both = stage(both.select(keyless, *[c for c in both.columns if c != "vin"]), "copies").df
    batched = batching.assign_batches(both, LISTINGS)
    found = duplicates.find_duplicates(batched, "vin")
    marked = duplicates.mark_duplicates(batched, found)
    hit = F.col(duplicates.REPEATED_KEY) | F.col(duplicates.COPIED_ROW)
    counts = marked.groupBy(BATCH).agg(
        F.count_if(hit).alias("n_duplicates"),
        F.count_if(duplicates.REPEATED_KEY).alias("n_repeated"),
    )
    copied = found.copies_per_batch()
    counts = counts.join(copied, BATCH, "left")
    return counts.withColumn("n_copies", F.coalesce("n_copies", F.lit(0).cast("bigint")))


@query
def category_violations(spark, sf_dir):
    rows, rules = _kept_rules(testdata.listings(spark, sf_dir), LISTINGS)
    hit = rows.filter(rules.unknown_category())
    return hit.groupBy(BATCH, "title_status").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def consistency_violations(spark, sf_dir):
    rows, rules = _kept_rules(testdata.listings(spark, sf_dir), LISTINGS)
    hit = rows.filter(rules.inconsistent())
    return hit.groupBy(BATCH).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("mileage").alias("max_mileage")
    )


@query
def check_results(spark, sf_dir):
    results = _report(_defective(spark, sf_dir), LISTINGS).results
    position = F.col("position").cast("int").alias("position")
    return results.select(
        BATCH, position, "name", "passed", "severity", "n_violations", "n_rows", "detail"
    )


@query
def check_samples(spark, sf_dir):
    report = _report(_defective(spark, sf_dir), LISTINGS)
    samples = checks.check_samples(report.flagged, ("vin_strict",))
    fields = "vin string, vin_strict string, brand string, model string, condition string, title_status string, state string, year double, mileage double, price double, posting_date timestamp"
    row = F.from_json("sample", fields)
    names = [f.split()[0] for f in fields.split(", ")]
    shown = {c: row[c] for c in names} | {"posting_date": F.date_format(row["posting_date"], "yyyy-MM-dd HH:mm:ss")}
    rank = F.col("rank").cast("int").alias("rank")
    return samples.select(BATCH, "name", rank, *[v.alias(c) for c, v in shown.items()])


@query
def violations_exploded(spark, sf_dir):
    report = _report(_defective(spark, sf_dir), LISTINGS)
    return checks.violations(report.flagged).select(BATCH, "name", "vin_strict", "vin")


@query
def report_summary(spark, sf_dir):
    lines = checks.summary_lines(_report(_defective(spark, sf_dir), LISTINGS).results)
    position = F.col("position").cast("int").alias("position")
    return lines.select(BATCH, position, "status", "line")


@query
def report_totals(spark, sf_dir):
    totals = checks.report_totals(_report(_defective(spark, sf_dir), LISTINGS).results)
    return totals.drop(PERIOD)


# -------------------------------------------------------------------------------------- gate


def _verdicts(report: checks.BatchReport) -> DataFrame:
    return gate.gate_verdicts(report).select(
        BATCH,
        "n_rows",
        "n_error_rows",
        _round("error_fraction", "error_fraction"),
        "dq_pass_rate",
        "n_error_checks",
        "fatal",
        "halted",
        "reason",
        "n_quarantined",
    )


@query
def weekly_gate(spark, sf_dir):
    return _verdicts(_report(testdata.events(spark, sf_dir), EVENTS))


@query
def gate_verdicts(spark, sf_dir):
    return _verdicts(_report(_listings(spark, sf_dir), LISTINGS))


@query
def gate_over_ceiling(spark, sf_dir):
    return _verdicts(_report(_listings(spark, sf_dir), LISTINGS.but(key="vin_strict")))


@query
def gate_mixed(spark, sf_dir):
    return _verdicts(_report(_listings(spark, sf_dir), STRICT))


@query
def gate_batch_fatal(spark, sf_dir):
    rows = _listings(spark, sf_dir).drop("mileage")
    return _verdicts(_report(rows, LISTINGS))


def _split(df: DataFrame, profile: TableProfile) -> tuple[DataFrame, DataFrame]:
    report = _report(df, profile).store()
    return gate.split_clean_quarantine(report.flagged, gate.staged_verdicts(report))


@query
def clean_rows(spark, sf_dir):
    clean, _ = _split(_defective(spark, sf_dir), DEFECTIVE)
    return clean.select(BATCH, "vin", "model", "brand", "year", "mileage", "price")


@query
def quarantine_rows(spark, sf_dir):
    _, held = _split(_defective(spark, sf_dir), DEFECTIVE)
    flags = F.concat_ws(",", checks.FLAGS).alias("flags")
    return held.select(BATCH, "vin", "vin_strict", "brand", "year", "price", flags)


@query
def catch_rate(spark, sf_dir):
    verdicts = gate.gate_verdicts(_report(_listings(spark, sf_dir), STRICT))
    return gate.catch_rate(verdicts).withColumn("catch_rate", _round("catch_rate"))


# ------------------------------------------------------------------------------------- drift


def _psi(df: DataFrame, profile: TableProfile) -> DataFrame:
    clean, _, passing = _passed(df, profile)
    columns = list(profile.drift.psi_columns)
    values = drift.psi_by_batch(clean, passing, columns, profile.drift.psi_bins)
    return values.select(BATCH, *[_round(f"psi_{c}", f"psi_{c}") for c in columns])


@query
def psi_consecutive(spark, sf_dir):
    return _psi(testdata.events(spark, sf_dir), EVENTS)


@query
def psi_quarterly(spark, sf_dir):
    return _psi(_listings(spark, sf_dir), LISTINGS)


@query
def psi_price_shock(spark, sf_dir):
    return _psi(_drifting(spark, sf_dir, SHOCK), LISTINGS)


def _statistics(df: DataFrame, profile: TableProfile) -> tuple[DataFrame, Staged]:
    clean, _, passing = _passed(df, profile)
    return clean, stage(drift.batch_statistics(clean, passing, profile), "statistics")


@query
def null_rate_delta(spark, sf_dir):
    _, statistics = _statistics(_drifting(spark, sf_dir, TREND), TRENDING)
    columns = ["mileage", "price", "brand"]
    deltas = drift.null_rate_deltas(statistics.df, columns)
    return deltas.select(BATCH, *[_round(f"delta_{c}", f"delta_{c}") for c in columns])


@query
def category_shift(spark, sf_dir):
    columns = ["title_status", "brand", "model"]
    profile = TRENDING.with_drift(category_columns=tuple(columns))
    clean, statistics = _statistics(_drifting(spark, sf_dir, TREND), profile)
    shifts = drift.category_shift_by_batch(clean, statistics, columns)
    return shifts.select(BATCH, *[_round(f"shift_{c}", f"shift_{c}") for c in columns])


@query
def category_shift_weekly(spark, sf_dir):
    clean, statistics = _statistics(testdata.events(spark, sf_dir), EVENTS)
    shifts = drift.category_shift_by_batch(clean, statistics, ["event_type"])
    return shifts.select(BATCH, _round("shift_event_type", "shift_event_type"))


@query
def freshness_by_batch(spark, sf_dir):
    _, statistics = _statistics(testdata.events(spark, sf_dir), EVENTS)
    return statistics.df.select(BATCH, "n_clean", "freshness_days")


@query
def column_stats(spark, sf_dir):
    _, statistics = _statistics(_drifting(spark, sf_dir, TREND), TRENDING)
    columns = ("price", "mileage", "year")
    return statistics.df.select(
        BATCH,
        *[F.round(f"mean_{c}", 4).alias(f"mean_{c}") for c in columns],
        *[_round(f"null_{c}", f"null_{c}") for c in columns],
    )


@query
def drift_alerts(spark, sf_dir):
    clean, _, passing = _passed(_drifting(spark, sf_dir, TREND), TRENDING)
    record = drift.compute_drift(clean, passing, TRENDING)
    return record.select(
        BATCH,
        drift.has_alert(F.col("drift")).alias("has_alert"),
        F.concat_ws("; ", "drift.alerts").alias("alerts"),
    )


@query
def previous_batch_threading(spark, sf_dir):
    verdicts = gate.staged_verdicts(_report(_listings(spark, sf_dir), STRICT))
    passing = verdicts.df.filter(~F.col("halted"))
    return drift.previous_batches(passing).select(BATCH, F.col(drift.PREVIOUS).alias("previous"))


# ------------------------------------------------------------------------------- run history


def _history(df: DataFrame, profile: TableProfile) -> DataFrame:
    """Run records without training, stamped, as the history holds them."""
    clean, verdicts, passing = _passed(df, profile)
    found = drift.compute_drift(clean, passing, profile)
    return stage(runs.stamp_runs(runs.run_records(verdicts.df, found)), "runs").df


def _flat_runs(history: DataFrame) -> DataFrame:
    return history.select(
        "batch_label",
        _date("period_start"),
        "n_rows",
        "dq_pass_rate",
        "n_error_checks",
        "freshness_days",
        "n_quarantined",
        "halted",
        "n_undated",
    )


@query
def run_history(spark, sf_dir):
    return _flat_runs(_history(testdata.events(spark, sf_dir), EVENTS))


@query
def run_history_halts(spark, sf_dir):
    return _flat_runs(_history(_listings(spark, sf_dir), STRICT))


@query
def latest_run(spark, sf_dir):
    store = _store(spark)
    runs.save_runs(store, _history(testdata.events(spark, sf_dir), EVENTS))
    return _flat_runs(runs.latest_run(runs.load_runs(store)))


@query
def run_history_json(spark, sf_dir):
    history = _history(testdata.events(spark, sf_dir), EVENTS)
    texts = stage(runs.export_json(history), "runs-json").df
    back = runs.import_json(texts)
    return views.psi_frame(back, ["value"]).select("batch_label", _round("value", "value"))


# ---------------------------------------------------------------------------------- features


def _split_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Feature rows of all listings, split into training and test rows."""
    rows = testdata.listings(spark, sf_dir).withColumn("_split_key", F.col("vin_strict"))
    rows = features.clean_features(rows, LISTINGS, keep=("_split_key",))
    rows = stage(rows, "feature-rows").df
    return features.split(rows, F.col("_split_key"), LISTINGS.test_size, LISTINGS.seed)


@query
def clean_features(spark, sf_dir):
    rows = _defective(spark, sf_dir).withColumn(
        "price", F.when(~F.col("price").between(0, 1), F.col("price"))
    )
    return features.clean_features(rows, LISTINGS)


@query
def split_counts(spark, sf_dir):
    train, test = _split_rows(spark, sf_dir)
    sides = train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )
    return sides.groupBy("side").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("_split_key").alias("first_key"),
        F.max("_split_key").alias("last_key"),
    )


def _gappy_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows in which some mileages are missing."""
    train, _ = _split_rows(spark, sf_dir)
    gap = inject.hash32("gap", F.col("_split_key")) % 1000 < 150
    return train.withColumn("mileage", F.when(~gap, F.col("mileage")))


@query
def train_medians(spark, sf_dir):
    fitted = features.numeric_statistics(_gappy_training(spark, sf_dir), ["year", "mileage"])
    rows = [(c, *values) for c, values in fitted.items()]
    table = spark.createDataFrame(rows, "feature string, median double, mean double, scale double")
    return table.select("feature", *[_round(c, c) for c in ("median", "mean", "scale")])


@query
def scaled_numeric(spark, sf_dir):
    train = _gappy_training(spark, sf_dir)
    profile = LISTINGS.but(categorical=())
    encoders = features.fit_preprocessor(train.select("_split_key", "year", "mileage", "price"), profile)
    made = encoders.transform(train, training=True)
    place = {name: i for i, name in enumerate(encoders.feature_names)}
    values = F.transform(
        F.from_json(F.get_json_object(F.to_json(F.struct("features")), "$.features.values"), "array<double>"),
        lambda x: x,
    )
    return made.select(
        F.col("_split_key").alias("vin_strict"),
        F.round(values[place["num__year"]], 4).alias("year"),
        F.round(values[place["num__mileage"]], 4).alias("mileage"),
    )


@query
def category_counts(spark, sf_dir):
    train, _ = _split_rows(spark, sf_dir)
    return features.category_counts(train, list(LISTINGS.categorical))


@query
def capped_categories(spark, sf_dir):
    train, _ = _split_rows(spark, sf_dir)
    counts = stage(features.category_counts(train, list(LISTINGS.categorical)), "counts").df
    return features.capped_categories(counts, LISTINGS.max_categories)


@query
def onehot_nonzeros(spark, sf_dir):
    train, test = _split_rows(spark, sf_dir)
    known = train.filter(~F.col("brand").isin("Brand#1", "Brand#2"))
    encoders = features.fit_preprocessor(known, LISTINGS.but(numeric=()).but(max_categories=20))
    made = encoders.transform(test)
    indices = F.from_json(
        F.get_json_object(F.to_json(F.struct("features")), "$.features.indices"), "array<int>"
    )
    hot = made.select(F.explode(indices).alias("position")).groupBy("position").agg(F.count(F.lit(1)).alias("n_rows"))
    hot = hot.join(encoders.features(), "position")
    return hot.filter(F.col("feature").startswith("cat__")).select("feature", "n_rows")


@query
def onehot_uncapped(spark, sf_dir):
    """Positions of all rows' labels where every label has a feature, keys and models among them."""
    rows = testdata.listings(spark, sf_dir).withColumn("_split_key", F.col("vin_strict"))
    profile = LISTINGS.but(numeric=("year",), categorical=("vin", "model", "state"), max_categories=None)
    rows = stage(features.clean_features(rows, profile, keep=("_split_key",)), "feature-rows").df
    train, _ = features.split(rows, F.col("_split_key"), profile.test_size, profile.seed)
    encoders = features.fit_preprocessor(train.drop("_split_key"), profile)
    made = encoders.transform(rows).withColumn("v", F.to_json(F.struct(features.FEATURES)))
    return made.select(
        F.col("_split_key").alias("vin_strict"),
        "vin",
        "model",
        F.get_json_object("v", "$.features.size").cast("int").alias("size"),
        F.get_json_object("v", "$.features.indices").alias("positions"),
    )


# ------------------------------------------------------------------------- models and metrics


def _two_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out predictions of the mean baseline and of least squares over all features."""
    train, test = _split_rows(spark, sf_dir)
    encoders = features.fit_preprocessor(train, LISTINGS)
    entries = encoders.encode(models.labelled(train, LISTINGS), training=True)
    n_features = encoders.n_features
    direct = n_features <= models.DIRECT_FEATURES
    if not direct:
        entries = stage(entries, "entries").df
    rows = entries.select(features.LABEL, features.vector(n_features).alias(features.FEATURES))
    sums = models.products(entries, []).collect() if direct else None  # pairs of features
    line = models.fit_linear(rows, sums, n_features)
    fitted = {metrics.BASELINE: models.mean_model(rows), models.LINEAR: line}
    return models.predict_all(fitted, encoders.transform(models.labelled(test, LISTINGS)))


_METRICS = ("mae", "rmse", "r2", "mape")


@query
def model_metrics(spark, sf_dir):
    scored = metrics.score(_two_models(spark, sf_dir))
    return scored.select("model", F.col("ord").cast("int").alias("ord"), *[F.round(m, 4).alias(m) for m in _METRICS])


@query
def winner_and_improvement(spark, sf_dir):
    best = metrics.winner(stage(metrics.score(_two_models(spark, sf_dir)), "metrics").df)
    rounded = [F.round(m, 4).alias(m) for m in ("mae", "baseline_mae", "improvement_pct")]
    return best.select("winner", "beats_baseline", *rounded)


@query
def winner_per_batch(spark, sf_dir):
    """Every quarter's prices predicted by the overall mean and by half of it."""
    rows = batching.assign_batches(testdata.listings(spark, sf_dir), LISTINGS)
    mean = F.lit(rows.agg(F.avg("price")).first()[0])
    guesses = F.array(
        F.struct(F.lit(metrics.BASELINE).alias("model"), F.lit(0).alias("ord"), mean.alias("prediction")),
        F.struct(F.lit("half_mean").alias("model"), F.lit(1).alias("ord"), (mean / 2).alias("prediction")),
    )
    rows = rows.select(BATCH, F.col("price").alias("label"), F.inline(guesses))
    best = metrics.winner(metrics.score(rows, [BATCH]), [BATCH])
    return best.select(
        BATCH, "winner", "beats_baseline", F.round("mae", 4).alias("mae"), F.round("r2", 4).alias("r2")
    )


@query
def model_comparison(spark, sf_dir):
    """All four models on one batch of listings, with a small forest."""
    profile = LISTINGS.but(models=SMALL_FOREST)
    rows = batching.single_batch(_listings(spark, sf_dir).filter(F.col("price") >= 1))
    scored, _ = models.train_and_score(rows, profile)
    return scored.select("model", *[F.round(m, 4).alias(m) for m in _METRICS])


# -------------------------------------------------------------------------------------- views


def _event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(testdata.events(spark, sf_dir), EVENTS)


@query
def view_quality(spark, sf_dir):
    return views.quality_frame(_event_history(spark, sf_dir))


@query
def view_psi(spark, sf_dir):
    history = _history(_listings(spark, sf_dir), LISTINGS)
    frame = views.psi_frame(history, LISTINGS.drift.psi_columns)
    return frame.select("batch_label", *[_round(c, c) for c in LISTINGS.drift.psi_columns])


@query
def view_null_rate(spark, sf_dir):
    history = _history(_drifting(spark, sf_dir, TREND), TRENDING)
    frame = views.null_rate_frame(history, LISTINGS.drift.psi_columns)
    return frame.select("batch_label", *[_round(c, c) for c in LISTINGS.drift.psi_columns])


@query
def view_category_shift(spark, sf_dir):
    history = _history(_listings(spark, sf_dir), LISTINGS)
    frame = views.category_shift_frame(history, LISTINGS.drift.category_columns)
    return frame.select("batch_label", *[_round(c, c) for c in LISTINGS.drift.category_columns])


@query
def view_freshness(spark, sf_dir):
    return views.freshness_frame(_event_history(spark, sf_dir))


@query
def view_headline(spark, sf_dir):
    return views.headline(_event_history(spark, sf_dir))


@query
def view_report(spark, sf_dir):
    table = views.report_table(_report(_listings(spark, sf_dir), LISTINGS).results)
    return table.withColumn("position", F.col("position").cast("int"))


@query
def view_quarantine_count(spark, sf_dir):
    return views.report_quarantine_count(_report(_listings(spark, sf_dir), LISTINGS).flagged)


@query
def view_models(spark, sf_dir):
    """Winning model's errors of one yearly backfill with a small forest."""
    profile = LISTINGS.but(freq="Y", models=SMALL_FOREST)
    result = run_batches(_listings(spark, sf_dir), profile, _store(spark))
    frame = views.model_frame(result.runs)
    return frame.select("batch_label", *[F.round(m, 4).alias(m) for m in ("mae", "rmse", "r2")])


# ---------------------------------------------------------------------------- fault injection


@query
def inject_ground_truth(spark, sf_dir):
    rows = testdata.listings(spark, sf_dir)
    hit = inject.inject_defects(rows, _row_key(), BAD_FRACTION, STALE_ANCHOR)
    return inject.defect_counts(hit).withColumnRenamed(inject.DEFECT, "defect")


@query
def inject_defect_values(spark, sf_dir):
    rows = testdata.listings(spark, sf_dir)
    hit = inject.inject_defects(rows, _row_key(), BAD_FRACTION, STALE_ANCHOR)
    date = F.date_format("posting_date", "yyyy-MM-dd").alias("posting_date")
    hit = hit.filter(F.col(inject.DEFECT).isNotNull())
    return hit.select(
        F.col(inject.DEFECT).alias("defect"), "vin_strict", "vin", "brand", "price", "year", date
    )


@query
def inject_drift_profile(spark, sf_dir):
    rows = testdata.listings(spark, sf_dir)
    changed = inject.inject_drift(rows, _row_key(), TREND, "Q", FIRST_PERIOD)
    batched = batching.assign_batches(changed, LISTINGS)
    return batched.groupBy(BATCH).agg(
        F.round(F.avg("price"), 4).alias("mean_price"),
        F.count_if(F.col("mileage").isNull()).alias("n_null_mileage"),
        F.count_if(F.col("brand") == TREND.new_category).alias("n_new_brand"),
    )


@query
def caught_defects(spark, sf_dir):
    """Injected defects against the checks that named their rows."""
    flagged = _flagged_defects(_defective(spark, sf_dir))
    hit = flagged.filter(F.col(inject.DEFECT).isNotNull())
    return hit.groupBy(F.col(inject.DEFECT).alias("defect")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(checks.IS_ERROR).alias("n_caught"),
    )


def _flagged_defects(rows: DataFrame) -> DataFrame:
    """Flagged rows with their recorded defect beside the verdict."""
    profile = DEFECTIVE.but(min_batch_rows=1, min_rows=1)
    renamed = rows.withColumnRenamed(inject.DEFECT, "defect")
    flagged = _report(renamed, profile).flagged
    return flagged.withColumnRenamed("defect", inject.DEFECT)


# ----------------------------------------------------------------------------- whole pipeline


@query
def single_batch_run(spark, sf_dir):
    rows = _listings(spark, sf_dir)
    result = run_batches(rows, LISTINGS, _store(spark), backfill=False, train=False)
    return result.runs.select(
        "batch_label", "n_rows", "dq_pass_rate", "n_error_checks", "n_quarantined", "freshness_days", "halted"
    )


@query
def backfill_runs(spark, sf_dir):
    result = run_batches(_listings(spark, sf_dir), STRICT, _store(spark), train=False)
    return _flat_runs(result.runs)


@query
def backfill_tables(spark, sf_dir):
    """Rows per batch in the stored clean and quarantine tables of a backfill."""
    result = run_batches(_defective(spark, sf_dir), DEFECTIVE, _store(spark), train=False)
    clean = result.clean.select(BATCH, F.lit("clean").alias("disposition"))
    held = result.quarantine.select(BATCH, F.lit("quarantine").alias("disposition"))
    both = clean.unionByName(held)
    return both.groupBy(BATCH, "disposition").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def validate_report(spark, sf_dir):
    report = validate(testdata.events(spark, sf_dir), EVENTS)
    position = F.col("position").cast("int").alias("position")
    lines = report.results.select(position, "name", "passed", "severity", "n_violations", "detail")
    return lines.withColumn("report_passes", F.lit(passes(report)))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate verdicts of every weekly batch of events."""
    return QUERIES["weekly_gate"](spark, sf_dir)

