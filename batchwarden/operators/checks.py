"""The eight data-quality checks, for all batches in one plan.

Row-level rules are plain expressions fused into one projection.  What depends on a whole batch
(null fractions, repeated keys) is aggregated first and joined back as a small staged table.  The
verdicts stay in the row, as an array of check names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from batchwarden.functions.coerce import is_missing, to_number
from batchwarden.operators import duplicates as dup
from batchwarden.operators.batching import (
    BATCH,
    PERIOD,
    batch_sizes,
    empty_batch,
    source_columns,
)
from batchwarden.profile import ERROR, WARN, ColumnRule, TableProfile
from batchwarden.sources.staging import Staged, stage

# Check names, in report order (the category check carries its column's name).
COLUMNS = "columns"
SCHEMA = "schema"
MIN_ROWS = "min_rows"
NULLS = "nulls"
RANGES = "ranges"
DUPLICATES = "duplicates"
CONSISTENCY = "consistency"

BATCH_FATAL = (COLUMNS, MIN_ROWS)
FLAGS = "_flags"
IS_ERROR = "_is_error"
SAMPLE_ROWS = 5


def _any(tests: list[Column]) -> Column:
    """OR of the tests with NULL read as false."""
    settled = [F.coalesce(t, F.lit(False)) for t in tests]
    return reduce(Column.__or__, settled, F.lit(False))


def _outside_whole(value: Column, low: float, high: float) -> Column:
    """Whether a number, cut to a whole number, lies outside [low, high]."""
    below = value < low if low > 0 else value <= low - 1
    above = value >= high + 1 if high >= 0 else value > high
    return below | above


class RowRules:
    """Row-level rule expressions of a profile over the columns a table has."""

    def __init__(self, schema: T.StructType, profile: TableProfile):
        self.types = {f.name: f.dataType for f in schema.fields}
        self.profile = profile
        self.missing = [c for c in profile.required if c not in self.types]
        self.absent_rules = [r for r in profile.schema if r.name not in self.types]
        self.null_columns = [c for c in profile.null_fraction_max if c in self.types]
        self.range_columns = [c for c in profile.ranges if c in self.types]

    def number(self, name: str) -> Column:
        """A column read as a number."""
        return to_number(F.col(name), self.types[name])

    def null(self, name: str) -> Column:
        """Whether a cell is empty."""
        return is_missing(F.col(name), self.types[name])

    def _schema_failure(self, rule: ColumnRule) -> Column:
        """1 if the cell breaks its column rule: empty, not castable or out of range."""
        broken = F.when(self.null(rule.name), F.lit(0 if rule.nullable else 1))
        if rule.kind == "string":
            return broken.otherwise(0)
        value = self.number(rule.name)
        broken = broken.when(value.isNull(), 1)
        if rule.name in self.profile.ranges:
            low, high = self.profile.ranges[rule.name]
            if rule.kind == "int":
                outside = _outside_whole(value, low, high)
            else:
                outside = ~value.between(low, high)
            broken = broken.when(outside, 1)
        return broken.otherwise(0)

    def schema_failures(self) -> Column:
        """Number of broken column rules in the row."""
        present = [r for r in self.profile.schema if r.name in self.types]
        return reduce(Column.__add__, [self._schema_failure(r) for r in present], F.lit(0))

    def out_of_range(self, name: str) -> Column:
        """Whether the cell is a number outside its domain."""
        low, high = self.profile.ranges[name]
        return F.coalesce(~self.number(name).between(low, high), F.lit(False))

    def any_out_of_range(self) -> Column:
        """Whether any cell of the row is outside its domain."""
        return _any([self.out_of_range(c) for c in self.range_columns])

    @property
    def has_category(self) -> bool:
        """Whether the monitored category column exists."""
        return self.profile.category_column in self.types

    def unknown_category(self) -> Column:
        """Whether the category is given but not a known one."""
        if not self.has_category:
            return F.lit(False)
        value = F.col(self.profile.category_column)
        return value.isNotNull() & ~_any([value.isin(*self.profile.known_values)])

    @property
    def has_consistency(self) -> bool:
        """Whether both columns of the cross-field rule exist."""
        rule = self.profile.consistency
        return rule is not None and rule.column in self.types and rule.measure in self.types

    def inconsistent(self) -> Column:
        """Whether the row claims a fresh state beside a measure above its maximum."""
        if not self.has_consistency:
            return F.lit(False)
        rule = self.profile.consistency
        state = F.lower(F.col(rule.column).cast("string"))
        fresh = state.isin(*[v.lower() for v in rule.values])
        return F.coalesce(fresh & (self.number(rule.measure) > rule.maximum), F.lit(False))


def _counted(text: str, count: Column) -> Column:
    """``text`` with its ``{n}`` replaced by a count."""
    before, _, after = text.partition("{n}")
    return F.concat(F.lit(before), count.cast("string"), F.lit(after))


def _percent(fraction: Column, digits: int) -> Column:
    """A fraction as a percentage text."""
    return F.format_string(f"%.{digits}f%%", fraction * 100)


@dataclass
class BatchReport:
    """Checks over a table that carries ``_batch``: facts, flagged rows, results and verdicts.

    With ``whole`` the table is one batch that is reported even when it is empty; otherwise
    batches below the profile's minimum size are left out.
    """

    batched: DataFrame
    profile: TableProfile
    whole: bool = False

    @cached_property
    def rules(self) -> RowRules:
        """The row-level rules that apply to the table."""
        source = self.batched.select(*source_columns(self.batched))
        return RowRules(source.schema, self.profile)

    @cached_property
    def facts(self) -> Staged:
        """Per batch: row count, empty cells per policed column, and the null verdict."""
        rules = self.rules
        names = {c: f"null_{c}" for c in rules.null_columns}
        counts = [F.count_if(rules.null(c)).alias(n) for c, n in names.items()]
        sizes = batch_sizes(self.batched, counts)
        if self.whole:
            seed = empty_batch(self.batched).select(BATCH, PERIOD)
            sizes = seed.join(sizes.drop(PERIOD), BATCH, "left").fillna(0)
        else:
            sizes = sizes.filter(F.col("n_rows") >= self.profile.min_batch_rows)
        limits = self.profile.null_fraction_max
        for column, name in names.items():
            share = F.try_divide(F.col(name), F.col("n_rows"))
            sizes = sizes.withColumn(
                f"_over_{column}", F.coalesce(share > limits[column], F.lit(False))
            )
        strict = [F.col(f"_over_{c}") for c in rules.null_columns if limits[c] == 0.0]
        return stage(sizes.withColumn("_nulls_error", _any(strict)), "facts")

    @cached_property
    def kept(self) -> DataFrame:
        """The rows of the reported batches, with the null verdict of their batch."""
        over = [f"_over_{c}" for c in self.rules.null_columns]
        facts = self.facts.side().select(BATCH, "_nulls_error", *over)
        return self.batched.join(facts, BATCH)

    @cached_property
    def duplicates(self) -> dup.Duplicates:
        """Repeated keys and copied rows of the reported batches."""
        source = self.batched.columns
        return dup.find_duplicates(self.kept.select(*source), self.profile.key)

    @cached_property
    def judged(self) -> DataFrame:
        """Every row with one column per check outcome."""
        rules = self.rules
        rows = dup.mark_duplicates(self.kept, self.duplicates)
        nulls = [F.col(f"_over_{c}") & rules.null(c) for c in rules.null_columns]
        return rows.withColumns(
            {
                "_schema": rules.schema_failures(),
                "_nulls": _any(nulls),
                "_ranges": rules.any_out_of_range(),
                "_duplicate": F.col(dup.REPEATED_KEY) | F.col(dup.COPIED_ROW),
                "_category": rules.unknown_category(),
                "_inconsistent": rules.inconsistent(),
            }
        )

    def store(self) -> BatchReport:
        """Write the judged rows, so that whoever reads summary and rows does not judge every row again."""
        self.judged = stage(self.judged, "judged").df
        return self

    def _outcomes(self) -> list[tuple[str, Column, Column]]:
        """Row-level checks: name, whether the row offends, whether that is an error."""
        key_error = F.lit(self.profile.key_severity == ERROR)
        return [
            (SCHEMA, F.col("_schema") > 0, F.lit(True)),
            (NULLS, F.col("_nulls"), F.col("_nulls_error")),
            (RANGES, F.col("_ranges"), F.lit(True)),
            (DUPLICATES, F.col("_duplicate"), key_error),
            (self.profile.category_check, F.col("_category"), F.lit(False)),
            (CONSISTENCY, F.col("_inconsistent"), F.lit(False)),
        ]

    @cached_property
    def flagged(self) -> DataFrame:
        """The data with ``_flags`` (failed checks naming the row) and ``_is_error``."""
        outcomes = self._outcomes()
        flags = F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit, _ in outcomes]))
        error = _any([hit & grave for _, hit, grave in outcomes])
        source = source_columns(self.batched)
        return self.judged.select(
            *source, BATCH, PERIOD, flags.alias(FLAGS), error.alias(IS_ERROR)
        )

    @cached_property
    def summary(self) -> Staged:
        """One wide row per batch: every count the report and the gate are made of."""
        rules = self.rules
        error = _any([hit & grave for _, hit, grave in self._outcomes()])
        counts = [
            F.sum("_schema").cast("bigint").alias("n_schema"),
            F.count_if("_ranges").alias("n_ranges"),
            F.count_if("_duplicate").alias("n_duplicates"),
            F.count_if(dup.REPEATED_KEY).alias("n_repeated"),
            F.count_if("_category").alias("n_category"),
            F.count_if("_inconsistent").alias("n_inconsistent"),
            F.count_if(error).alias("n_error_rows"),
        ]
        counts += [F.count_if(rules.out_of_range(c)).alias(f"out_{c}") for c in rules.range_columns]
        table = self.facts.side().join(self.judged.groupBy(BATCH).agg(*counts), BATCH, "left")
        copies = self.duplicates.copies_per_batch()
        if copies is None:
            table = table.withColumn("n_copies", F.lit(0).cast("bigint"))
        else:
            table = table.join(copies, BATCH, "left")
        return stage(table.fillna(0), "summary")

    @cached_property
    def results(self) -> DataFrame:
        """Eight rows per batch, in report order."""
        entries = [
            F.struct(
                F.lit(position).alias("position"),
                F.lit(name).alias("name"),
                passed.alias("passed"),
                severity.alias("severity"),
                count.cast("bigint").alias("n_violations"),
                F.col("n_rows"),
                detail.alias("detail"),
            )
            for position, (name, passed, severity, count, detail) in enumerate(self.entries())
        ]
        return self.summary.df.select(BATCH, PERIOD, F.inline(F.array(*entries)))

    def entries(self) -> list[tuple[str, Column, Column, Column, Column]]:
        """Name, passed, severity, violations and detail of each check of a summary row."""
        profile, rules = self.profile, self.rules
        n = {c: F.col(c) for c in self.summary.df.columns}

        def plain(name, severity, count, detail):
            return name, count == 0, F.lit(severity), count, detail

        missing = F.lit(len(rules.missing))
        columns_text = "all required columns present"
        if rules.missing:
            columns_text = f"missing columns: {rules.missing}"

        broken = n["n_schema"] + len(rules.absent_rules)
        schema_text = F.when(broken == 0, F.lit("schema OK")).otherwise(
            _counted("{n} schema violation(s)", broken)
        )

        short = F.when(n["n_rows"] < profile.min_rows, 1).otherwise(0)
        rows_text = _counted(f"{{n}} rows (min {profile.min_rows})", n["n_rows"])

        limits = profile.null_fraction_max
        over = {c: n[f"_over_{c}"] for c in rules.null_columns}
        any_over = _any(list(over.values()))
        cells = [F.when(o, n[f"null_{c}"]).otherwise(0) for c, o in over.items()]
        n_nulls = reduce(Column.__add__, cells, F.lit(0))
        null_parts = [
            F.when(
                o,
                F.concat(
                    F.lit(f"{c}: "),
                    _percent(F.try_divide(n[f"null_{c}"], n["n_rows"]), 1),
                    F.lit(f" > {limits[c]:.0%}"),
                ),
            )
            for c, o in over.items()
        ]
        null_text = F.when(~any_over, F.lit("null fractions within thresholds")).otherwise(
            F.concat_ws("; ", *null_parts)
        )
        null_severity = F.when(n["_nulls_error"], F.lit(ERROR)).otherwise(F.lit(WARN))

        range_parts = []
        for c in rules.range_columns:
            low, high = profile.ranges[c]
            text = _counted(f"{c}: {{n}} outside [{low}, {high}]", n[f"out_{c}"])
            range_parts.append(F.when(n[f"out_{c}"] > 0, text))
        range_text = F.when(n["n_ranges"] == 0, F.lit("all values within range")).otherwise(
            F.concat_ws("; ", *range_parts)
        )

        duplicate_text = F.when(
            n["n_duplicates"] == 0, F.lit("no duplicate rows or keys")
        ).otherwise(
            F.concat_ws(
                "; ",
                F.when(
                    n["n_copies"] > 0,
                    _counted("{n} fully-duplicated row(s)", n["n_copies"]),
                ),
                F.when(
                    n["n_repeated"] > 0,
                    _counted(f"{{n}} row(s) with a repeated {profile.key}", n["n_repeated"]),
                ),
            )
        )

        known = list(profile.known_values)
        category_text = F.lit(f"{profile.category_column} absent; skipped")
        if rules.has_category:
            category_text = F.when(
                n["n_category"] == 0, F.lit(f"all {profile.category_column} values known")
            ).otherwise(_counted(f"{{n}} value(s) outside {known}", n["n_category"]))

        rule = profile.consistency
        consistency_text = F.lit("no consistency rule; skipped")
        if rule is not None:
            consistency_text = F.lit(f"{rule.column}/{rule.measure} absent; skipped")
        if rules.has_consistency:
            values = "/".join(rule.values)
            consistency_text = F.when(
                n["n_inconsistent"] == 0,
                F.lit(f"{rule.column} and {rule.measure} consistent"),
            ).otherwise(
                _counted(
                    f"{{n}} '{values}' row(s) with {rule.measure} over {rule.maximum:g}",
                    n["n_inconsistent"],
                )
            )

        return [
            (COLUMNS, missing == 0, F.lit(ERROR), missing, F.lit(columns_text)),
            plain(SCHEMA, ERROR, broken, schema_text),
            plain(MIN_ROWS, ERROR, short, rows_text),
            (NULLS, ~any_over, null_severity, n_nulls, null_text),
            plain(RANGES, ERROR, n["n_ranges"], range_text),
            plain(DUPLICATES, profile.key_severity, n["n_duplicates"], duplicate_text),
            plain(profile.category_check, WARN, n["n_category"], category_text),
            plain(CONSISTENCY, WARN, n["n_inconsistent"], consistency_text),
        ]


def violations(flagged: DataFrame) -> DataFrame:
    """One row per (row, failed check): the full set of offenders."""
    return flagged.filter(F.size(FLAGS) > 0).withColumn("name", F.explode(FLAGS)).drop(FLAGS)


def check_samples(
    flagged: DataFrame, order_by: tuple[str, ...] = (), size: int = SAMPLE_ROWS
) -> DataFrame:
    """The first few offenders of every check and batch as JSON text, in key order.

    The rank limit is applied before the shuffle too, so each task hands on a few rows per group.
    """
    columns = source_columns(flagged)
    order = list(dict.fromkeys([*order_by, *columns]))
    window = Window.partitionBy(BATCH, "name").orderBy(*order)
    ranked = violations(flagged).withColumn("rank", F.row_number().over(window))
    row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return ranked.filter(F.col("rank") <= size).select(BATCH, "name", "rank", row.alias("sample"))


def report_totals(results: DataFrame) -> DataFrame:
    """Per batch: passed checks, failed warnings, failed errors, and whether the batch passes."""
    failed = ~F.col("passed")
    return results.groupBy(BATCH, PERIOD).agg(
        F.count_if("passed").alias("n_passed"),
        F.count_if(failed & (F.col("severity") == WARN)).alias("n_warn"),
        F.count_if(failed & (F.col("severity") == ERROR)).alias("n_error_checks"),
        F.count(F.lit(1)).alias("n_checks"),
    ).withColumn("passed", F.col("n_error_checks") == 0)


def summary_lines(results: DataFrame) -> DataFrame:
    """One readable line per check: its status, name and detail."""
    status = F.when(F.col("passed"), F.lit("PASS")).otherwise(F.col("severity"))
    line = F.format_string("[%-5s] %-14s %s", status, F.col("name"), F.col("detail"))
    return results.select(BATCH, PERIOD, "position", "name", status.alias("status"), line.alias("line"))
