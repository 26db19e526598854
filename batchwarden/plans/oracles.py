"""SQL statements of the registered queries, for comparison on another engine.

They are written independently of the operators: whole-table windows and joins instead of staged
aggregates.  Where a query has no entry, its result depends on model fitting.
"""

from __future__ import annotations

from batchwarden.operators import inject
from batchwarden.plans import catalog
from batchwarden.profile import TableProfile
from batchwarden.profiles import EVENTS, LISTINGS
from batchwarden.sources.testdata import LISTINGS_SQL

ORACLES: dict[str, str] = {}

_LABELS = {
    "W": "strftime({d}, '%G-W%V')",
    "D": "strftime({d}, '%Y-%m-%d')",
    "M": "strftime({d}, '%Y-%m')",
    "Q": "concat(year({d}), 'Q', quarter({d}))",
    "Y": "strftime({d}, '%Y')",
}
_UNITS = {"W": "week", "D": "day", "M": "month", "Q": "quarter", "Y": "year"}


def _draw(seed: str, key: str) -> str:
    """The 32-bit hash of a key."""
    return f"('0x' || substr(md5(concat('{seed}|', {key})), 1, 8))::BIGINT"


ROW_KEY = "concat_ws('|', vin, model, state)"
EVENTS_SRC = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
LISTINGS_SRC = f"SELECT vin, vin_strict, brand, model, condition, title_status, state, year, mileage, posting_date, price FROM ({LISTINGS_SQL})"


def _defective() -> str:
    limit = int(round(catalog.BAD_FRACTION * 10000))
    group = ", ".join(f"'{d}'" for d in inject.DEFECTS)
    years = ", ".join(str(y) for y in inject.IMPOSSIBLE_YEARS)
    return f"""
    SELECT CASE WHEN d = 'duplicate_vin' THEN '{inject.SHARED_VIN}' ELSE vin END AS vin, vin_strict,
           CASE WHEN d = 'null_brand' THEN NULL ELSE brand END AS brand,
           model, condition, title_status, state,
           CASE WHEN d = 'impossible_year' THEN ([{years}])[v % 6 + 1] ELSE year END AS year,
           mileage,
           CASE WHEN d = 'stale_date' THEN TIMESTAMP '{catalog.STALE_ANCHOR}' - INTERVAL {inject.STALE_DAYS} DAY
                ELSE posting_date END AS posting_date,
           CASE WHEN d = 'nonpositive_price'
                THEN CASE WHEN v % 2 = 0 THEN 0.0::DOUBLE ELSE -((v % 5000) + 1)::DOUBLE END
                ELSE price END AS price,
           d AS defect
    FROM (SELECT *, CASE WHEN h % 10000 < {limit} THEN ([{group}])[h % 10000 % 5 + 1] END AS d
          FROM (SELECT *, {_draw("42", ROW_KEY)} AS h, {_draw("42v", ROW_KEY)} AS v
                FROM ({LISTINGS_SRC})))
    """


def _drifting(spec: inject.DriftSpec) -> str:
    price = f"price * pow({1.0 + spec.inflation}::DOUBLE, k)"
    if spec.shock_period is not None:
        price = f"CASE WHEN k >= {spec.shock_period} THEN {price} * {spec.shock_multiplier} ELSE {price} END"
    mileage, brand = "mileage", "brand"
    if spec.rising_null_column:
        share = f"least(greatest({spec.null_base} + {spec.null_step} * k, 0.0), {spec.null_limit})"
        draw = f"{_draw('42n', ROW_KEY)} / 4294967296.0::DOUBLE"
        mileage = f"CASE WHEN {draw} >= {share}::DOUBLE THEN mileage END"
    if spec.new_category_period is not None:
        draw = f"{_draw('42c', ROW_KEY)} / 4294967296.0::DOUBLE"
        brand = (
            f"CASE WHEN k >= {spec.new_category_period} AND {draw} < {spec.new_category_share}::DOUBLE"
            f" THEN '{spec.new_category}' ELSE brand END"
        )
    return f"""
    SELECT vin, vin_strict, {brand} AS brand, model, condition, title_status, state, year,
           {mileage} AS mileage, posting_date, {price} AS price
    FROM (SELECT *, (year(posting_date) - 1995) * 4 + quarter(posting_date) - 1 AS k
          FROM ({LISTINGS_SRC}))
    """


EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
LISTING_COLUMNS = (
    "vin",
    "vin_strict",
    "brand",
    "model",
    "condition",
    "title_status",
    "state",
    "year",
    "mileage",
    "posting_date",
    "price",
)


def _any(tests: list[str]) -> str:
    return "(" + " OR ".join(f"coalesce({t}, false)" for t in tests) + ")" if tests else "false"


def report_ctes(
    src: str, profile: TableProfile, columns: tuple[str, ...], whole: bool = False
) -> str:
    """WITH clause up to ``judged`` (rows), ``summary`` (batches), ``results`` and ``verdicts``."""
    date = profile.date_column
    label = "'all'" if whole else _LABELS[profile.freq].format(d=date)
    start = "NULL::TIMESTAMP" if whole else f"date_trunc('{_UNITS[profile.freq]}', {date})"
    dated = "true" if whole else f"{date} IS NOT NULL"
    least = 0 if whole else profile.min_batch_rows
    present = [c for c in profile.null_fraction_max if c in columns]
    limits = profile.null_fraction_max
    ranged = [c for c in profile.ranges if c in columns]

    over = [
        f"count(*) FILTER ({c} IS NULL) AS null_{c}, "
        f"count(*) FILTER ({c} IS NULL) / count(*) > {limits[c]} AS over_{c}"
        for c in present
    ]
    strict = _any([f"over_{c}" for c in present if limits[c] == 0.0])

    rules = []
    for rule in profile.schema:
        if rule.name not in columns:
            continue
        c = rule.name
        empty = f"WHEN {c} IS NULL THEN {0 if rule.nullable else 1}"
        outside = ""
        if rule.kind != "string" and c in profile.ranges:
            low, high = profile.ranges[c]
            value = f"trunc({c})" if rule.kind == "int" else c
            outside = f"WHEN {value} NOT BETWEEN {low} AND {high} THEN 1"
        rules.append(f"CASE {empty} {outside} ELSE 0 END")
    out = {c: f"{c} NOT BETWEEN {profile.ranges[c][0]} AND {profile.ranges[c][1]}" for c in ranged}

    key = profile.key if profile.key in columns else None
    repeated = "false"
    if key:
        repeated = f"({key} IS NOT NULL AND count(*) OVER (PARTITION BY _batch, {key}) > 1)"
    copied = f"count(*) OVER (PARTITION BY _batch, {', '.join(columns)}) > 1"

    category = "false"
    if profile.category_column in columns:
        known = ", ".join(f"'{v}'" for v in profile.known_values)
        category = _any([f"{profile.category_column} NOT IN ({known})"])
    rule = profile.consistency
    fresh = "false"
    if rule is not None and rule.column in columns and rule.measure in columns:
        values = ", ".join(f"'{v.lower()}'" for v in rule.values)
        fresh = _any([f"lower({rule.column}) IN ({values}) AND {rule.measure} > {rule.maximum}"])

    missing = [c for c in profile.required if c not in columns]
    absent = len([r for r in profile.schema if r.name not in columns])
    key_error = str(profile.key_severity == "ERROR").lower()
    nulls_hit = _any([f"over_{c} AND {c} IS NULL" for c in present])

    null_parts = ", ".join(
        f"CASE WHEN over_{c} THEN concat('{c}: ', printf('%.1f%%', 100.0 * null_{c} / n_rows), "
        f"' > {limits[c]:.0%}') END"
        for c in present
    )
    range_parts = ", ".join(
        f"CASE WHEN out_{c} > 0 THEN concat('{c}: ', out_{c}, ' outside "
        f"[{profile.ranges[c][0]}, {profile.ranges[c][1]}]') END"
        for c in ranged
    )
    any_over = _any([f"over_{c}" for c in present])
    cells = " + ".join(f"CASE WHEN over_{c} THEN null_{c} ELSE 0 END" for c in present) or "0"
    known_text = str(list(profile.known_values)).replace("'", "''")
    category_text = f"'{profile.category_column} absent; skipped'"
    if profile.category_column in columns:
        category_text = (
            f"CASE WHEN n_category = 0 THEN 'all {profile.category_column} values known' "
            f"ELSE concat(n_category, ' value(s) outside {known_text}') END"
        )
    consistency_text = "'no consistency rule; skipped'"
    if rule is not None:
        consistency_text = f"'{rule.column}/{rule.measure} absent; skipped'"
        if rule.column in columns and rule.measure in columns:
            consistency_text = (
                f"CASE WHEN n_inconsistent = 0 THEN '{rule.column} and {rule.measure} consistent' "
                f"ELSE concat(n_inconsistent, ' ''{'/'.join(rule.values)}'' row(s) with "
                f"{rule.measure} over {rule.maximum:g}') END"
            )
    columns_text = "all required columns present"
    if missing:
        columns_text = f"missing columns: {missing}".replace("'", "''")

    def entry(position, name, passed, severity, count, detail):
        return (
            f"SELECT _batch, _start, {position}::INTEGER AS position, '{name}' AS name, "
            f"({passed}) AS passed, {severity} AS severity, ({count})::BIGINT AS n_violations, "
            f"n_rows, {detail} AS detail FROM summary"
        )

    short = f"CASE WHEN n_rows < {profile.min_rows} THEN 1 ELSE 0 END"
    entries = [
        entry(0, "columns", str(not missing), "'ERROR'", len(missing), f"'{columns_text}'"),
        entry(
            1,
            "schema",
            f"n_schema + {absent} = 0",
            "'ERROR'",
            f"n_schema + {absent}",
            f"CASE WHEN n_schema + {absent} = 0 THEN 'schema OK' "
            f"ELSE concat(n_schema + {absent}, ' schema violation(s)') END",
        ),
        entry(
            2,
            "min_rows",
            f"n_rows >= {profile.min_rows}",
            "'ERROR'",
            short,
            f"concat(n_rows, ' rows (min {profile.min_rows})')",
        ),
        entry(
            3,
            "nulls",
            f"NOT {any_over}",
            "CASE WHEN nulls_error THEN 'ERROR' ELSE 'WARN' END",
            cells,
            f"CASE WHEN NOT {any_over} THEN 'null fractions within thresholds' "
            f"ELSE concat_ws('; ', {null_parts or 'NULL'}) END",
        ),
        entry(
            4,
            "ranges",
            "n_ranges = 0",
            "'ERROR'",
            "n_ranges",
            f"CASE WHEN n_ranges = 0 THEN 'all values within range' "
            f"ELSE concat_ws('; ', {range_parts}) END",
        ),
        entry(
            5,
            "duplicates",
            "n_duplicates = 0",
            f"'{profile.key_severity}'",
            "n_duplicates",
            "CASE WHEN n_duplicates = 0 THEN 'no duplicate rows or keys' ELSE concat_ws('; ', "
            "CASE WHEN n_copies > 0 THEN concat(n_copies, ' fully-duplicated row(s)') END, "
            f"CASE WHEN n_repeated > 0 THEN concat(n_repeated, ' row(s) with a repeated {profile.key}') END) END",
        ),
        entry(6, profile.category_check, "n_category = 0", "'WARN'", "n_category", category_text),
        entry(
            7, "consistency", "n_inconsistent = 0", "'WARN'", "n_inconsistent", consistency_text
        ),
    ]

    # Counted over the rows of the summary's batches; an empty whole table still has its batch.
    return f"""
    WITH src AS ({src}),
    batched AS (SELECT *, {label} AS _batch, {start} AS _start FROM src WHERE {dated}),
    facts AS (
      SELECT *, {strict} AS nulls_error FROM (
        SELECT _batch, _start, count(*) AS n_rows, {', '.join(over) or '0 AS none'}
        FROM batched GROUP BY _batch, _start HAVING count(*) >= {least})),
    judged AS (
      SELECT *, ({' + '.join(rules) or '0'}) AS f_schema, {nulls_hit} AS f_nulls,
             {_any(list(out.values()))} AS f_ranges, {repeated} AS f_repeated,
             {copied} AS f_copied, {category} AS f_category, {fresh} AS f_inconsistent
      FROM (SELECT b.*, f.* EXCLUDE (_batch, _start) FROM batched b JOIN facts f USING (_batch))),
    flagged AS (
      SELECT *, f_repeated OR f_copied AS f_duplicate,
             f_schema > 0 OR (f_nulls AND nulls_error) OR f_ranges
               OR ((f_repeated OR f_copied) AND {key_error}) AS is_error,
             concat_ws(',', CASE WHEN f_schema > 0 THEN 'schema' END,
                            CASE WHEN f_nulls THEN 'nulls' END,
                            CASE WHEN f_ranges THEN 'ranges' END,
                            CASE WHEN f_repeated OR f_copied THEN 'duplicates' END,
                            CASE WHEN f_category THEN '{profile.category_check}' END,
                            CASE WHEN f_inconsistent THEN 'consistency' END) AS flags
      FROM judged),
    summary AS (
      SELECT f.*, s.* EXCLUDE (_batch) FROM facts f JOIN (
        SELECT _batch, sum(f_schema)::BIGINT AS n_schema,
               count(*) FILTER (f_ranges) AS n_ranges,
               count(*) FILTER (f_duplicate) AS n_duplicates,
               count(*) FILTER (f_repeated) AS n_repeated,
               count(*) FILTER (f_copied) AS n_copies,
               count(*) FILTER (f_category) AS n_category,
               count(*) FILTER (f_inconsistent) AS n_inconsistent,
               count(*) FILTER (is_error) AS n_error_rows
               {''.join(f", count(*) FILTER (coalesce({t}, false)) AS out_{c}" for c, t in out.items())}
        FROM flagged GROUP BY _batch) s USING (_batch)),
    results AS ({' UNION ALL '.join(entries)}),
    verdicts AS (
      SELECT s._batch, s._start, s.n_rows, s.n_error_rows,
             s.n_error_rows / greatest(s.n_rows, 1) AS error_fraction,
             r.dq_pass_rate, r.n_error_checks, r.fatal,
             r.fatal OR s.n_error_rows / greatest(s.n_rows, 1) > {profile.max_error_fraction} AS halted,
             CASE WHEN r.fatal THEN 'batch-fatal (empty/truncated or missing columns)'
                  WHEN s.n_error_rows / greatest(s.n_rows, 1) > {profile.max_error_fraction}
                  THEN concat('ERROR-row fraction ',
                              printf('%.1f%%', 100.0 * s.n_error_rows / s.n_rows),
                              ' > ceiling {profile.max_error_fraction:.0%}') END AS reason,
             CASE WHEN r.fatal OR s.n_error_rows / greatest(s.n_rows, 1) > {profile.max_error_fraction}
                  THEN 0 ELSE s.n_error_rows END::BIGINT AS n_quarantined
      FROM summary s JOIN (
        SELECT _batch, avg(passed::INT) AS dq_pass_rate,
               count(*) FILTER (NOT passed AND severity = 'ERROR') AS n_error_checks,
               bool_or(NOT passed AND severity = 'ERROR' AND name IN ('columns', 'min_rows')) AS fatal
        FROM results GROUP BY _batch) r USING (_batch)),
    passing AS (SELECT * FROM verdicts WHERE NOT halted),
    clean AS (SELECT f.* FROM flagged f SEMI JOIN passing USING (_batch) WHERE NOT is_error),
    held AS (SELECT f.* FROM flagged f SEMI JOIN passing USING (_batch) WHERE is_error)
    """


def drift_ctes(profile: TableProfile, psi=(), shifts=(), deltas=()) -> str:
    """Further WITH entries over ``clean`` and ``passing``: ``stats``, ``psi_<c>``, ``shift_<c>``."""
    reference = profile.drift.reference_date
    empty = "".join(
        f", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_{c}"
        for c in dict.fromkeys([*deltas, *psi])
    )
    means = "".join(f", avg({c}) AS mean_{c}" for c in psi)
    ctes = f""",
    pairs AS (SELECT _batch, _start, lag(_batch) OVER (ORDER BY _start) AS previous FROM passing),
    stats AS (
      SELECT p._batch, p._start, p.previous, s.* EXCLUDE (_batch),
             floor((epoch_us(TIMESTAMP '{reference}') - epoch_us(newest)) / 86400000000.0) AS freshness_days
      FROM pairs p JOIN (
        SELECT _batch, count(*) AS n_clean, max({profile.date_column}) AS newest {empty} {means}
        FROM clean GROUP BY _batch) s USING (_batch))
    """
    bins = profile.drift.psi_bins
    shares = ", ".join(str(i / bins) for i in range(bins + 1))
    for c in psi:
        ctes += f""",
    edges_{c} AS (
      SELECT _batch, u[2:len(u) - 1] AS inner_edges, len(u) AS n_edges FROM (
        SELECT _batch, list_sort(list_distinct(quantile_cont({c}, [{shares}]))) AS u
        FROM clean GROUP BY _batch)),
    bins_{c} AS (
      SELECT pair, side, bin, count(*) AS n FROM (
        SELECT p._batch AS pair, 'a' AS side, len([x for x in e.inner_edges if x <= c.{c}]) AS bin
        FROM clean c JOIN pairs p ON c._batch = p._batch JOIN edges_{c} e ON e._batch = p.previous
        WHERE c.{c} IS NOT NULL
        UNION ALL
        SELECT p._batch AS pair, 'e' AS side, len([x for x in e.inner_edges if x <= c.{c}]) AS bin
        FROM clean c JOIN pairs p ON c._batch = p.previous JOIN edges_{c} e ON e._batch = p.previous
        WHERE c.{c} IS NOT NULL) GROUP BY ALL),
    shares_{c} AS (
      SELECT pair, bin, sum(CASE WHEN side = 'a' THEN share ELSE 0 END) + 1e-6 AS a,
             sum(CASE WHEN side = 'e' THEN share ELSE 0 END) + 1e-6 AS e
      FROM (SELECT *, n / sum(n) OVER (PARTITION BY pair, side) AS share FROM bins_{c})
      GROUP BY pair, bin),
    psi_{c} AS (
      SELECT p._batch, CASE WHEN p.previous IS NOT NULL THEN coalesce(s.v, 0.0) END AS v
      FROM pairs p LEFT JOIN (SELECT pair, sum((a - e) * ln(a / e)) AS v FROM shares_{c}
                              GROUP BY pair) s ON s.pair = p._batch)
    """
    for c in shifts:
        ctes += f""",
    cat_{c} AS (
      SELECT _batch, {c} AS value, count(*) / sum(count(*)) OVER (PARTITION BY _batch) AS share
      FROM clean WHERE {c} IS NOT NULL GROUP BY _batch, {c}),
    shift_{c} AS (
      SELECT p._batch, CASE WHEN p.previous IS NOT NULL THEN coalesce(d.v, 0.0) END AS v
      FROM pairs p LEFT JOIN (
        SELECT pair, max(abs(cur - prev)) AS v FROM (
          SELECT coalesce(a.pair, b.pair) AS pair, coalesce(a.share, 0) AS cur,
                 coalesce(b.share, 0) AS prev
          FROM (SELECT q._batch AS pair, x.value, x.share FROM pairs q JOIN cat_{c} x ON x._batch = q._batch) a
          FULL JOIN (SELECT q._batch AS pair, x.value, x.share FROM pairs q JOIN cat_{c} x ON x._batch = q.previous) b
            ON a.pair = b.pair AND a.value = b.value) GROUP BY pair) d ON d.pair = p._batch)
    """
    return ctes


def _events(profile: TableProfile = EVENTS, whole: bool = False) -> str:
    return report_ctes(EVENTS_SRC, profile, EVENT_COLUMNS, whole)


def _listings(profile: TableProfile = LISTINGS, whole: bool = False) -> str:
    return report_ctes(LISTINGS_SRC, profile, LISTING_COLUMNS, whole)


def _bad(profile: TableProfile = LISTINGS) -> str:
    return report_ctes(_defective(), profile, LISTING_COLUMNS)


def _trend() -> str:
    return report_ctes(_drifting(catalog.TREND), catalog.TRENDING, LISTING_COLUMNS)


# ---------------------------------------------------------------------------------- batching


def _counts(src: str, date: str, freq: str, least: int) -> str:
    start = f"date_trunc('{_UNITS[freq]}', {date})"
    return f"""
    SELECT _batch, strftime(start, '%Y-%m-%d') AS period_start,
           (row_number() OVER (ORDER BY start) - 1)::INTEGER AS position, n_rows,
           n_rows >= {least} AS kept
    FROM (SELECT {_LABELS[freq].format(d=date)} AS _batch, {start} AS start, count(*) AS n_rows
          FROM ({src}) GROUP BY ALL)
    """


ORACLES["batch_counts_weekly"] = _counts(EVENTS_SRC, "ts", "W", 100)
ORACLES["batch_counts_daily"] = _counts(EVENTS_SRC, "ts", "D", 20)
ORACLES["batch_counts_quarterly"] = _counts(LISTINGS_SRC, "posting_date", "Q", 100)
ORACLES["batch_counts_monthly"] = _counts(LISTINGS_SRC, "posting_date", "M", 100)
ORACLES["batch_counts_yearly"] = _counts(LISTINGS_SRC, "posting_date", "Y", 100)
ORACLES["kept_batch_rows"] = """
    SELECT event_id, strftime(ts, '%G-W%V') AS _batch,
           strftime(date_trunc('week', ts), '%Y-%m-%d') AS period_start
    FROM events
    QUALIFY count(*) OVER (PARTITION BY date_trunc('week', ts)) >= 700
    """
ORACLES["undated_rows"] = """
    SELECT count(*) FILTER (event_id % 19 = 0) AS n_undated, count(*) AS n_rows FROM events
    """

# ------------------------------------------------------------------------ scans and coercion

_TYPED = """
    SELECT event_id,
           CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL
                WHEN event_id % 13 <> 0 AND event_id % 17 = 0 THEN NULL ELSE value END AS value,
           CASE WHEN event_id % 19 = 0 THEN NULL
                WHEN event_id % 5 = 0 THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S')
                WHEN event_id % 3 = 0 THEN strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S')
                ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
           event_type
    FROM events
    """
ORACLES["coerce_numeric_timestamp"] = _TYPED
ORACLES["csv_scan_mapped"] = f"""
    SELECT event_id, value, ts, concat(event_type, ',', chr(10), '"x"') AS event_type
    FROM ({_TYPED})
    """
_PRECISION = "CASE WHEN event_id % 10 = 0 THEN 'second' WHEN event_id % 10 IN (4, 5) THEN 'minute' ELSE 'day' END"
ORACLES["date_renderings"] = f"""
    SELECT event_id, CASE WHEN event_id % 10 < 8 THEN strftime(date_trunc({_PRECISION}, ts), '%Y-%m-%d %H:%M:%S') END AS ts
    FROM events
    """
ORACLES["date_format_counts"] = """
    SELECT ['iso', 'year_first', 'month_first', 'long_month', 'half_day', 'month_first_minutes', 'short_month', 'digits',
            'unreadable', 'missing'][event_id % 10 + 1] AS format, count(*) AS n_rows
    FROM events GROUP BY ALL
    """
ORACLES["header_normalisation"] = """
    SELECT p_partkey AS part, p_brand AS brand, p_retailprice AS mileage FROM part
    """
ORACLES["read_by_sql"] = """
    SELECT event_type, count(*) AS n_rows, round(sum(value), 4) AS total
    FROM events WHERE value > 50 GROUP BY event_type
    """
ORACLES["table_write_append"] = """
    SELECT event_type, 2 * count(*) AS n_rows, (SELECT 2 * count(*) FROM events)::BIGINT AS n_written
    FROM events GROUP BY event_type
    """
ORACLES["table_refresh"] = """
    SELECT CASE WHEN b = '2024-W02' THEN -event_id ELSE event_id END AS event_id, b AS _batch
    FROM (SELECT event_id, strftime(ts, '%G-W%V') AS b FROM events)
    """
ORACLES["strict_gate_load"] = """
    SELECT event_type, count(*) AS n_rows,
           (SELECT count(*) > 0 FROM events WHERE value NOT BETWEEN 1 AND 200) AS refused,
           (SELECT count(*) FROM events) AS n_loaded
    FROM events GROUP BY event_type
    """

# ------------------------------------------------------------------------------------ checks

ORACLES["schema_failures"] = f"""{_bad()}
    SELECT _batch, sum(f_schema)::BIGINT AS n_failures, count(*) FILTER (f_schema > 0) AS n_rows
    FROM flagged GROUP BY _batch
    """
ORACLES["range_violations"] = f"""{_bad()}
    SELECT _batch, n_ranges AS n_rows, out_price AS n_price, out_year AS n_year,
           out_mileage AS n_mileage FROM summary
    """
for _name, _limits in {
    "null_policy": {"price": 0.0, "brand": catalog.TOLERANT_BRAND, "mileage": 0.2},
    "null_policy_escalated": {"brand": 0.0, "mileage": 0.2},
}.items():
    ORACLES[_name] = f"""{_bad(LISTINGS.but(null_fraction_max=_limits))}
    SELECT _batch, passed, severity, n_violations, detail FROM results WHERE name = 'nulls'
    """
ORACLES["duplicate_keys"] = f"""{_listings()}
    SELECT _batch, vin, count(*) AS n FROM flagged GROUP BY _batch, vin HAVING count(*) > 1
    """
_COPY_DRAW = f"{_draw('dup', ROW_KEY)} % 1000"
_COPIES = f"""
    SELECT CASE WHEN {_COPY_DRAW} >= {catalog.KEYLESS_SHARE} THEN vin END AS vin,
           l.* EXCLUDE (vin, times)
    FROM (SELECT *, CASE WHEN {_COPY_DRAW} < {catalog.COPY_SHARE} THEN 2 ELSE 1 END AS times
          FROM ({LISTINGS_SRC})) l, range(2) t(i) WHERE i < times
    """
ORACLES["duplicate_rows"] = f"""
    WITH src AS ({_COPIES}),
    b AS (SELECT *, concat(year(posting_date), 'Q', quarter(posting_date)) AS _batch FROM src),
    j AS (SELECT _batch,
                 vin IS NOT NULL AND count(*) OVER (PARTITION BY _batch, vin) > 1 AS rep,
                 count(*) OVER (PARTITION BY _batch, {', '.join(LISTING_COLUMNS)}) > 1 AS cop
          FROM b)
    SELECT _batch, count(*) FILTER (rep OR cop) AS n_duplicates, count(*) FILTER (rep) AS n_repeated,
           count(*) FILTER (cop) AS n_copies FROM j GROUP BY _batch
    """
ORACLES["category_violations"] = f"""{_listings()}
    SELECT _batch, title_status, count(*) AS n_rows FROM flagged WHERE f_category GROUP BY ALL
    """
ORACLES["consistency_violations"] = f"""{_listings()}
    SELECT _batch, count(*) AS n_rows, max(mileage) AS max_mileage
    FROM flagged WHERE f_inconsistent GROUP BY _batch
    """
ORACLES["check_results"] = f"""{_bad()}
    SELECT _batch, position, name, passed, severity, n_violations, n_rows, detail FROM results
    """
ORACLES["check_samples"] = f"""{_bad()}
    SELECT _batch, name, rank, vin, vin_strict, brand, model, condition, title_status, state, year::DOUBLE AS year,
           mileage, price, strftime(posting_date, '%Y-%m-%d %H:%M:%S') AS posting_date FROM (
      SELECT *, row_number() OVER (PARTITION BY _batch, name ORDER BY vin_strict NULLS FIRST,
               {', '.join(f'{c} NULLS FIRST' for c in LISTING_COLUMNS)})::INTEGER AS rank
      FROM (SELECT *, unnest(string_split(flags, ',')) AS name FROM flagged WHERE flags <> ''))
    WHERE rank <= 5
    """
ORACLES["violations_exploded"] = f"""{_bad()}
    SELECT _batch, unnest(string_split(flags, ',')) AS name, vin_strict, vin
    FROM flagged WHERE flags <> ''
    """
ORACLES["report_summary"] = f"""{_bad()}
    SELECT _batch, position, CASE WHEN passed THEN 'PASS' ELSE severity END AS status,
           concat('[', rpad(CASE WHEN passed THEN 'PASS' ELSE severity END, 5, ' '), '] ',
                  CASE WHEN length(name) < 14 THEN rpad(name, 14, ' ') ELSE name END,
                  ' ', detail) AS line
    FROM results
    """
ORACLES["report_totals"] = f"""{_bad()}
    SELECT _batch, count(*) FILTER (passed) AS n_passed,
           count(*) FILTER (NOT passed AND severity = 'WARN') AS n_warn,
           count(*) FILTER (NOT passed AND severity = 'ERROR') AS n_error_checks,
           count(*) AS n_checks,
           count(*) FILTER (NOT passed AND severity = 'ERROR') = 0 AS passed
    FROM results GROUP BY _batch
    """

# -------------------------------------------------------------------------------------- gate

_VERDICTS = """
    SELECT _batch, n_rows, n_error_rows, round(error_fraction, 6) AS error_fraction, dq_pass_rate,
           n_error_checks, fatal, halted, reason, n_quarantined FROM verdicts
    """
ORACLES["weekly_gate"] = _events() + _VERDICTS
ORACLES["gate_verdicts"] = _listings() + _VERDICTS
ORACLES["gate_over_ceiling"] = _listings(LISTINGS.but(key="vin_strict")) + _VERDICTS
ORACLES["gate_mixed"] = _listings(catalog.STRICT) + _VERDICTS
_NO_MILEAGE = tuple(c for c in LISTING_COLUMNS if c != "mileage")
ORACLES["gate_batch_fatal"] = (
    report_ctes(f"SELECT {', '.join(_NO_MILEAGE)} FROM ({LISTINGS_SRC})", LISTINGS, _NO_MILEAGE)
    + _VERDICTS
)
ORACLES["clean_rows"] = f"""{_bad(catalog.DEFECTIVE)}
    SELECT _batch, vin, model, brand, year, mileage, price FROM clean
    """
ORACLES["quarantine_rows"] = f"""{_bad(catalog.DEFECTIVE)}
    SELECT _batch, vin, vin_strict, brand, year, price, flags FROM held
    """
ORACLES["catch_rate"] = f"""{_listings(catalog.STRICT)}
    SELECT sum(n_quarantined)::BIGINT AS n_quarantined, sum(n_rows)::BIGINT AS n_rows,
           round(sum(n_quarantined) / sum(n_rows), 6) AS catch_rate FROM verdicts
    """

# ------------------------------------------------------------------------------------- drift

_PSI = LISTINGS.drift.psi_columns


def _psi_select(columns) -> str:
    joins = " ".join(f"JOIN psi_{c} USING (_batch)" for c in columns)
    values = ", ".join(f"round(psi_{c}.v, 6) AS psi_{c}" for c in columns)
    return f"SELECT _batch, {values} FROM pairs {joins}"


ORACLES["psi_consecutive"] = (
    _events() + drift_ctes(EVENTS, psi=("value",)) + _psi_select(("value",))
)
ORACLES["psi_quarterly"] = _listings() + drift_ctes(LISTINGS, psi=_PSI) + _psi_select(_PSI)
ORACLES["psi_price_shock"] = (
    report_ctes(_drifting(catalog.SHOCK), LISTINGS, LISTING_COLUMNS)
    + drift_ctes(LISTINGS, psi=_PSI)
    + _psi_select(_PSI)
)
_DELTAS = ("mileage", "price", "brand")
ORACLES["null_rate_delta"] = f"""{_trend()} {drift_ctes(catalog.TRENDING, deltas=_DELTAS)}
    SELECT _batch, {', '.join(f'round(null_{c} - lag(null_{c}) OVER (ORDER BY _start), 6) AS delta_{c}' for c in _DELTAS)}
    FROM stats
    """
_SHIFTS = ("title_status", "brand", "model")
ORACLES["category_shift"] = f"""{_trend()} {drift_ctes(catalog.TRENDING, shifts=_SHIFTS)}
    SELECT _batch, {', '.join(f'round(shift_{c}.v, 6) AS shift_{c}' for c in _SHIFTS)}
    FROM pairs {' '.join(f'JOIN shift_{c} USING (_batch)' for c in _SHIFTS)}
    """
ORACLES["category_shift_weekly"] = f"""{_events()} {drift_ctes(EVENTS, shifts=("event_type",))}
    SELECT _batch, round(shift_event_type.v, 6) AS shift_event_type
    FROM pairs JOIN shift_event_type USING (_batch)
    """
ORACLES["freshness_by_batch"] = f"""{_events()} {drift_ctes(EVENTS)}
    SELECT _batch, n_clean, freshness_days FROM stats
    """
ORACLES["column_stats"] = f"""{_trend()} {drift_ctes(catalog.TRENDING, psi=_PSI)}
    SELECT _batch, {', '.join(f'round(mean_{c}, 4) AS mean_{c}' for c in _PSI)},
           {', '.join(f'round(null_{c}, 6) AS null_{c}' for c in _PSI)} FROM stats
    """


def _alerts() -> str:
    d = catalog.TRENDING.drift
    columns = LISTING_COLUMNS
    shifts = d.category_columns
    texts = [
        f"CASE WHEN psi_{c}.v > {d.psi_alert} THEN concat('PSI drift on {c}: ', printf('%.3f', psi_{c}.v), ' > {d.psi_alert}') END"
        for c in d.psi_columns
    ]
    texts += [
        f"CASE WHEN abs(d_{c}) > {d.null_rate_alert} THEN concat('null-rate drift on {c}: ', printf('%+.3f', d_{c})) END"
        for c in columns
    ]
    texts += [
        f"CASE WHEN shift_{c}.v > {d.category_alert} THEN concat('category shift on {c}: ', printf('%.3f', shift_{c}.v), ' > {d.category_alert}') END"
        for c in shifts
    ]
    texts.append(
        f"CASE WHEN freshness_days > {d.max_staleness_days} THEN concat('stale data: newest "
        f"posting_date ', printf('%.0f', freshness_days), 'd old > {d.max_staleness_days:.0f}d') END"
    )
    deltas = ", ".join(f"null_{c} - lag(null_{c}) OVER (ORDER BY _start) AS d_{c}" for c in columns)
    joins = [f"JOIN psi_{c} USING (_batch)" for c in d.psi_columns]
    joins += [f"JOIN shift_{c} USING (_batch)" for c in shifts]
    return f"""{_trend()} {drift_ctes(catalog.TRENDING, d.psi_columns, shifts, columns)}
    SELECT _batch, alerts <> '' AS has_alert, alerts FROM (
      SELECT _batch, CASE WHEN previous IS NULL THEN ''
                          ELSE concat_ws('; ', {', '.join(texts)}) END AS alerts
      FROM (SELECT _batch, previous, freshness_days, {deltas} FROM stats) {' '.join(joins)})
    """


ORACLES["drift_alerts"] = _alerts()
ORACLES["previous_batch_threading"] = f"""{_listings(catalog.STRICT)}
    SELECT _batch, lag(_batch) OVER (ORDER BY _start) AS previous FROM passing
    """

# ------------------------------------------------------------------------------- run history

_RUNS = """
    SELECT v._batch AS batch_label, strftime(v._start, '%Y-%m-%d') AS period_start, v.n_rows,
           v.dq_pass_rate, v.n_error_checks, coalesce(s.freshness_days, 0.0) AS freshness_days,
           v.n_quarantined, v.halted, 0::BIGINT AS n_undated
    FROM verdicts v LEFT JOIN stats s USING (_batch)
    """
ORACLES["run_history"] = _events() + drift_ctes(EVENTS) + _RUNS
ORACLES["run_history_halts"] = _listings(catalog.STRICT) + drift_ctes(catalog.STRICT) + _RUNS
ORACLES["latest_run"] = ORACLES["run_history"] + " ORDER BY v._start DESC LIMIT 1"
ORACLES["run_history_json"] = f"""{_events()} {drift_ctes(EVENTS, psi=("value",))}
    SELECT v._batch AS batch_label, round(p.v, 6) AS value
    FROM verdicts v LEFT JOIN psi_value p USING (_batch)
    """

# ---------------------------------------------------------------------------------- features

ORACLES["clean_features"] = f"""
    SELECT price, year::DOUBLE AS year, mileage, brand, model, condition, state
    FROM ({_defective()}) WHERE price NOT BETWEEN 0 AND 1
    """
_TEST_LIMIT = int(round(LISTINGS.test_size * 1000))
_SIDES = f"""
    WITH sides AS (
      SELECT *, CASE WHEN {_draw("42", "vin_strict")} % 1000 < {_TEST_LIMIT}
                     THEN 'test' ELSE 'train' END AS side
      FROM ({LISTINGS_SRC}))
    """
ORACLES["split_counts"] = f"""{_SIDES}
    SELECT side, count(*) AS n_rows, min(vin_strict) AS first_key, max(vin_strict) AS last_key
    FROM sides GROUP BY side
    """
_GAPPY = f"""{_SIDES},
    gappy AS (SELECT vin_strict, year,
                     CASE WHEN {_draw("gap", "vin_strict")} % 1000 >= 150 THEN mileage END AS mileage
              FROM sides WHERE side = 'train'),
    medians AS (SELECT quantile_cont(year, 0.5) AS my, quantile_cont(mileage, 0.5) AS mm FROM gappy),
    filled AS (SELECT vin_strict, coalesce(year, my)::DOUBLE AS year, coalesce(mileage, mm) AS mileage
               FROM gappy, medians),
    fitted AS (SELECT avg(year) AS ay, stddev_pop(year) AS sy, avg(mileage) AS am,
                      stddev_pop(mileage) AS sm FROM filled)
    """
ORACLES["train_medians"] = f"""{_GAPPY}
    SELECT 'year' AS feature, round(my, 6) AS median, round(ay, 6) AS mean, round(sy, 6) AS scale
    FROM medians, fitted
    UNION ALL
    SELECT 'mileage', round(mm, 6), round(am, 6), round(sm, 6) FROM medians, fitted
    """
ORACLES["scaled_numeric"] = f"""{_GAPPY}
    SELECT vin_strict, round((year - ay) / sy, 4) AS year, round((mileage - am) / sm, 4) AS mileage
    FROM filled, fitted
    """
_CATEGORIES = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", coalesce({c}, '__missing__') AS value, count(*) AS n "
    f"FROM sides WHERE side = 'train' GROUP BY ALL"
    for c in LISTINGS.categorical
)
ORACLES["category_counts"] = f"{_SIDES} SELECT * FROM ({_CATEGORIES})"
ORACLES["capped_categories"] = f"""{_SIDES}
    SELECT "column", value, n, size >= {LISTINGS.max_categories} AS capped FROM (
      SELECT *, count(*) OVER (PARTITION BY "column") AS size,
             row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value DESC) AS place
      FROM ({_CATEGORIES}))
    WHERE size < {LISTINGS.max_categories} OR place < {LISTINGS.max_categories}
    """
_ONE_HOT = " UNION ALL ".join(
    f"""
    SELECT concat('cat__{c}_', CASE WHEN k.place < 20 OR k.size < 20 THEN t.{c} ELSE '__infrequent__' END) AS feature
    FROM sides t JOIN (
      SELECT {c} AS value, count(*) OVER () AS size,
             row_number() OVER (ORDER BY count(*) DESC, {c} DESC) AS place
      FROM sides WHERE side = 'train' AND brand NOT IN ('Brand#1', 'Brand#2') GROUP BY {c}) k
      ON k.value = t.{c}
    WHERE t.side = 'test'"""
    for c in LISTINGS.categorical
)
ORACLES["onehot_nonzeros"] = f"""{_SIDES}
    SELECT feature, count(*) AS n_rows FROM ({_ONE_HOT}) GROUP BY feature
    """

ORACLES["onehot_uncapped"] = f"""{_SIDES},
    labels AS (
      SELECT DISTINCT c, CASE c WHEN 0 THEN vin WHEN 1 THEN model ELSE state END AS v
      FROM sides, (VALUES (0), (1), (2)) AS t(c) WHERE side = 'train'),
    placed AS (SELECT c, v, row_number() OVER (ORDER BY c, v) AS p FROM labels)
    SELECT s.vin_strict, s.vin, s.model, (SELECT count(*) + 1 FROM placed)::INTEGER AS size,
           concat('[0', coalesce(',' || a.p, ''), coalesce(',' || b.p, ''), coalesce(',' || d.p, ''), ']') AS positions
    FROM sides s LEFT JOIN placed a ON a.c = 0 AND a.v = s.vin LEFT JOIN placed b ON b.c = 1 AND b.v = s.model
    LEFT JOIN placed d ON d.c = 2 AND d.v = s.state
    """

# ------------------------------------------------------------------------- models and metrics

# Least squares over scaled numbers and one label's indicator less than each column has, by normal
# equations solved with Gauss-Jordan steps: one step per unknown, each over all cells.
_DUMMIES = " UNION ALL ".join(
    f"SELECT s.id, d.j, 1.0 AS v FROM rows s JOIN dummies d ON d.\"column\" = '{c}' "
    f"AND d.value = coalesce(s.{c}, '__missing__')"
    for c in LISTINGS.categorical
)
_SCORED = f"""{_SIDES.replace('WITH sides', 'WITH RECURSIVE sides')},
    rows AS MATERIALIZED (SELECT *, row_number() OVER () AS id FROM sides),
    own AS ({ORACLES["capped_categories"].removeprefix(_SIDES)}),
    dummies AS (
      SELECT "column", value, 3 + row_number() OVER (ORDER BY "column", value) AS j
      FROM (SELECT *, max(value) OVER (PARTITION BY "column") AS last FROM own) WHERE capped OR value <> last),
    scale AS (SELECT avg(year) AS ay, stddev_pop(year) AS sy, avg(mileage) AS am, stddev_pop(mileage) AS sm,
                     avg(price) AS mean FROM sides WHERE side = 'train'),
    x AS (
      SELECT id, 1 AS j, 1.0::DOUBLE AS v FROM rows
      UNION ALL SELECT id, 2, (year - ay) / sy FROM rows, scale
      UNION ALL SELECT id, 3, (mileage - am) / sm FROM rows, scale
      UNION ALL {_DUMMIES}),
    learned AS (SELECT x.*, price AS y FROM x JOIN rows USING (id) WHERE side = 'train'),
    unknowns AS (SELECT count(*) + 3 AS n FROM dummies),
    found AS (
      SELECT a.j AS i, b.j, sum(a.v * b.v) AS v FROM learned a JOIN learned b USING (id) GROUP BY ALL
      UNION ALL SELECT j, n + 1, sum(v * y) FROM learned, unknowns GROUP BY ALL),
    cells AS (
      SELECT 0 AS k, i, j, coalesce(found.v, 0) AS v
      FROM (SELECT unnest(range(1, n + 1)) AS i FROM unknowns) CROSS JOIN (SELECT unnest(range(1, n + 2)) AS j FROM unknowns)
      LEFT JOIN found USING (i, j)),
    solved(k, i, j, v) AS (
      SELECT * FROM cells
      UNION ALL
      SELECT a.k + 1, a.i, a.j, CASE WHEN a.i = a.k + 1 THEN a.v / p.v ELSE a.v - c.v * r.v / p.v END
      FROM solved a JOIN solved p ON p.i = a.k + 1 AND p.j = a.k + 1 JOIN solved r ON r.i = a.k + 1 AND r.j = a.j
      JOIN solved c ON c.j = a.k + 1 AND c.i = a.i WHERE a.k < (SELECT n FROM unknowns)),
    coefficients AS (SELECT i AS j, v AS b FROM solved, unknowns WHERE k = n AND solved.j = n + 1),
    guesses AS (
      SELECT 'mean_baseline' AS model, 0 AS ord, price AS y, mean AS p
      FROM sides, scale WHERE side = 'test'
      UNION ALL
      SELECT 'linear_regression', 1, min(price), sum(x.v * b) FROM rows JOIN x USING (id) JOIN coefficients USING (j)
      WHERE side = 'test' GROUP BY id),
    scored AS (
      SELECT model, ord, avg(abs(y - p)) AS mae, sqrt(avg((y - p) ** 2)) AS rmse,
             1 - avg((y - p) ** 2) / var_pop(y) AS r2,
             avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)) AS mape
      FROM guesses GROUP BY model, ord)
    """
ORACLES["model_metrics"] = f"""{_SCORED}
    SELECT model, ord::INTEGER AS ord, {', '.join(f'round({m}, 4) AS {m}' for m in ('mae', 'rmse', 'r2', 'mape'))}
    FROM scored
    """
ORACLES["winner_and_improvement"] = f"""{_SCORED},
    best AS (SELECT * FROM scored ORDER BY mae, ord LIMIT 1),
    base AS (SELECT mae AS baseline_mae FROM scored WHERE model = 'mean_baseline')
    SELECT model AS winner, model <> 'mean_baseline' AND mae < baseline_mae AS beats_baseline,
           round(mae, 4) AS mae, round(baseline_mae, 4) AS baseline_mae,
           CASE WHEN model <> 'mean_baseline' AND mae < baseline_mae
                THEN round((baseline_mae - mae) / baseline_mae * 100, 4) END AS improvement_pct
    FROM best, base
    """
ORACLES["winner_per_batch"] = f"""
    WITH b AS (SELECT concat(year(posting_date), 'Q', quarter(posting_date)) AS _batch, price
               FROM ({LISTINGS_SRC})),
    m AS (SELECT avg(price) AS mean FROM b),
    g AS (SELECT _batch, 'mean_baseline' AS model, 0 AS ord, price AS y, mean AS p FROM b, m
          UNION ALL SELECT _batch, 'half_mean', 1, price, mean / 2 FROM b, m),
    s AS (SELECT _batch, model, ord, avg(abs(y - p)) AS mae,
                 1 - avg((y - p) ** 2) / var_pop(y) AS r2 FROM g GROUP BY ALL)
    SELECT s._batch, s.model AS winner,
           s.model <> 'mean_baseline' AND s.mae < z.mae AS beats_baseline,
           round(s.mae, 4) AS mae, round(s.r2, 4) AS r2
    FROM s JOIN (SELECT _batch, mae FROM s WHERE model = 'mean_baseline') z USING (_batch)
    QUALIFY row_number() OVER (PARTITION BY s._batch ORDER BY s.mae, s.ord) = 1
    """

# -------------------------------------------------------------------------------------- views

ORACLES["view_quality"] = f"""{_events()}
    SELECT _batch AS batch_label, dq_pass_rate, n_error_checks, n_quarantined, n_rows FROM verdicts
    """


def _psi_view(columns) -> str:
    joins = " ".join(f"LEFT JOIN psi_{c} USING (_batch)" for c in columns)
    values = ", ".join(f"round(psi_{c}.v, 6) AS {c}" for c in columns)
    return f"SELECT _batch AS batch_label, {values} FROM verdicts {joins}"


ORACLES["view_psi"] = _listings() + drift_ctes(LISTINGS, psi=_PSI) + _psi_view(_PSI)
ORACLES["view_null_rate"] = f"""{_trend()} {drift_ctes(catalog.TRENDING, psi=_PSI)}
    SELECT v._batch AS batch_label, {', '.join(f'round(s.null_{c}, 6) AS {c}' for c in _PSI)}
    FROM verdicts v LEFT JOIN stats s USING (_batch)
    """
_CATS = LISTINGS.drift.category_columns
ORACLES["view_category_shift"] = f"""{_listings()} {drift_ctes(LISTINGS, shifts=_CATS)}
    SELECT _batch AS batch_label, {', '.join(f'round(shift_{c}.v, 6) AS {c}' for c in _CATS)}
    FROM verdicts {' '.join(f'LEFT JOIN shift_{c} USING (_batch)' for c in _CATS)}
    """
ORACLES["view_freshness"] = f"""{_events()} {drift_ctes(EVENTS)}
    SELECT v._batch AS batch_label, coalesce(s.freshness_days, 0.0) AS freshness_days
    FROM verdicts v LEFT JOIN stats s USING (_batch)
    """
ORACLES["view_headline"] = f"""{_events()}
    SELECT count(*) AS n_runs, arg_max(dq_pass_rate, _start) AS latest_dq_pass_rate,
           NULL::DOUBLE AS latest_mae, arg_max(n_quarantined, _start) AS latest_n_quarantined FROM verdicts
    """
ORACLES["view_report"] = f"""{_listings()}
    SELECT position, name, passed, severity, n_violations, detail FROM results
    WHERE _start = (SELECT max(_start) FROM results)
    """
ORACLES["view_quarantine_count"] = f"""{_listings()}
    SELECT count(*) FILTER (is_error) AS n_quarantined FROM flagged
    WHERE _start = (SELECT max(_start) FROM facts)
    """

# ---------------------------------------------------------------------------- fault injection

ORACLES["inject_ground_truth"] = f"""
    SELECT defect, count(*) AS n_rows FROM ({_defective()}) WHERE defect IS NOT NULL GROUP BY defect
    """
ORACLES["inject_defect_values"] = f"""
    SELECT defect, vin_strict, vin, brand, price, year,
           strftime(posting_date, '%Y-%m-%d') AS posting_date
    FROM ({_defective()}) WHERE defect IS NOT NULL
    """
ORACLES["inject_drift_profile"] = f"""
    SELECT concat(year(posting_date), 'Q', quarter(posting_date)) AS _batch,
           round(avg(price), 4) AS mean_price, count(*) FILTER (mileage IS NULL) AS n_null_mileage,
           count(*) FILTER (brand = '{catalog.TREND.new_category}') AS n_new_brand
    FROM ({_drifting(catalog.TREND)}) GROUP BY ALL
    """
ORACLES["caught_defects"] = f"""
    {_bad(catalog.DEFECTIVE.but(min_batch_rows=1, min_rows=1))}
    SELECT defect, count(*) AS n_rows, count(*) FILTER (is_error) AS n_caught
    FROM flagged WHERE defect IS NOT NULL GROUP BY defect
    """

# ----------------------------------------------------------------------------- whole pipeline

ORACLES["single_batch_run"] = f"""{_listings(whole=True)} {drift_ctes(LISTINGS)}
    SELECT v._batch AS batch_label, v.n_rows, v.dq_pass_rate, v.n_error_checks, v.n_quarantined,
           coalesce(s.freshness_days, 0.0) AS freshness_days, v.halted
    FROM verdicts v LEFT JOIN stats s USING (_batch)
    """
ORACLES["backfill_runs"] = ORACLES["run_history_halts"]
ORACLES["backfill_tables"] = f"""{_bad(catalog.DEFECTIVE)}
    SELECT _batch, 'clean' AS disposition, count(*) AS n_rows FROM clean GROUP BY _batch
    UNION ALL
    SELECT _batch, 'quarantine', count(*) FROM held GROUP BY _batch
    """
ORACLES["validate_report"] = f"""{_events(whole=True)}
    SELECT position, name, passed, severity, n_violations, detail,
           (SELECT count(*) = 0 FROM results WHERE NOT passed AND severity = 'ERROR') AS report_passes
    FROM results
    """
