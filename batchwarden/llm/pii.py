"""Personal data: patterns, and terms that give away the people behind them.

Patterns find the protected entities. Every run of letters of a text is then weighed by how much
information it carries about the entities that texts hold: each value on its own, and all values of
a kind pooled, as most values occur once. With c the number of texts out of N, the pointwise mutual
information log2(N c(term, entity) / (c(term) c(entity))) is taken as a share of the entity's own
information log2(N / c(entity)), so 1 means that the term never occurs without the entity. Estimates
from few texts are discounted by c / (c + 1) for the common texts and for the rarer of term and entity;
no count is required, but what two texts share cannot reach the threshold. From GENERALISE on a term
gives way to a broader one, a name or a term, from REMOVE on it is taken out: each of its occurrences
in every text that holds the entity.

Everything is built-in expressions; counts cover all documents and combine before each shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from batchwarden.llm.common import attach, fresh, stage, table

# Fixed patterns. Possessive repetition never gives back what it took, which none of these needs to,
# and keeps long texts from exhausting the stack; an e-mail can only begin where its run of letters
# begins or where the last match ended, which keeps the search linear.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
# No text without one of these holds any match.
HINT = r"@|\+[0-9]|[0-9]\.[0-9]|[0-9](?:[\x20-]?[0-9]){15}"
TERM = r"\p{L}{3,}"
GENERALISE = 0.5
REMOVE = 0.75
STEP = 64
SPAN = "array<struct<start:bigint,end:bigint,value:string>>"
KIND_SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and give it to ``body``, inside a single expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _before(lengths: Column) -> Column:
    """For each place of an array the sum of what precedes it, by sums of STEP values at a time."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / STEP).cast("int")), lambda b: _total(F.slice(lengths, b * STEP + 1, STEP)))
    empty = F.array(F.lit(0).cast("bigint"))
    sums = F.aggregate(blocks, empty, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    def place(s: Column) -> Column:
        within = lambda i: F.slice(lengths, i - i % STEP + 1, i % STEP)
        return F.transform(lengths, lambda _, i: F.get(s, F.floor(i / STEP).cast("int")) + _total(within(i)))

    return F.when(F.size(lengths) > 0, _let(sums, place)).otherwise(F.array().cast("array<bigint>"))


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches: start, end (exclusive, in code points), value.

    What a text splits into around its matches gives the distances between them.
    """

    def spans(value: Column, gap: Column) -> Column:
        lengths = F.transform(value, lambda v, i: (F.length(v) + F.length(F.get(gap, i))).cast("bigint"))

        def placed(before: Column) -> Column:
            def one(v: Column, i: Column) -> Column:
                start = F.get(before, i) + F.length(F.get(gap, i))
                return F.struct(start.alias("start"), (start + F.length(v)).alias("end"), v.alias("value"))

            return F.transform(value, one)

        return _let(lengths, lambda n: _let(_before(n), placed))

    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(0))
    some = _let(found, lambda v: _let(F.split(text, pattern, -1), lambda g: spans(v, g)))
    return F.when(text.rlike(pattern), some).otherwise(F.array().cast(SPAN))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def weight(i: Column) -> Column:
        digit = F.substring(digits, -i - 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, digit).otherwise(2 * digit - F.when(digit > 4, 9).otherwise(0))

    each = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), weight)
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _octet(part: Column) -> Column:
    """Whether digits denote at most 255, however many zeros lead."""
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _octet)
    if kind == "card":
        return _let(_digits(value), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All base spans of a text as an array of (kind, start, end, value), by kind, then start."""

    def of(kind: str) -> Column:
        good = F.filter(matches(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
        return F.transform(good, lambda s: F.struct(F.lit(kind).alias("kind"), *(s[c].alias(c) for c in ("start", "end", "value"))))

    return F.when(text.rlike(HINT), F.concat(*map(of, KINDS))).otherwise(F.array().cast(KIND_SPAN))


def _terms(text: Column) -> Column:
    """The different lower-cased runs of letters of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(f"({TERM})"), F.lit(0)), F.lower))


def found(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: ``key``, ``doc_id``, ``base`` spans, and ``rest``. Staged.

    ``rest`` is the text with its entities blanked, at its full length; null where nothing hints at any.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), body.alias("text"), text_key(df, doc_id, text).alias("key"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    blank = replaced(F.col("text"), by_start("base"), lambda a, s: F.repeat(F.lit(" "), (s["end"] - F.greatest(a["at"], s["start"])).cast("int")))
    rest = F.when(F.size("base") > 0, blank).when(F.col("text").rlike(HINT), F.col("text"))
    return stage(rows.select("key", "doc_id", "base", rest.alias("rest")), "entities")


def text_key(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Column:
    """What tells the texts of ``df`` apart: repeated rows share it, one doc_id with two texts does not."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return F.concat_ws(":", F.col(f"`{doc_id}`").cast("string"), F.hex(F.xxhash64(body)))


def holdings(entities: DataFrame) -> DataFrame:
    """(``key``, ``copy``: digest of the text, ``entity``): the values and kinds that each text holds. Staged."""
    names = F.flatten(F.transform("base", lambda s: F.array(s["kind"], F.concat_ws(":", s["kind"], F.lower(s["value"])))))
    told = F.xxhash64("rest", F.transform("base", lambda s: s["value"])).alias("copy")
    held = entities.filter("size(base) > 0").select("key", told, F.explode(F.array_distinct(names)).alias("entity"))
    return stage(held.distinct(), "holdings")


def disclosing(df: DataFrame, entities: DataFrame, held: DataFrame, text: str = "text") -> DataFrame:
    """(``entity``, ``term``, ``share``): the terms that exceed the lower disclosure threshold. Staged.

    Of equal texts that may hold entities one counts, so repetition alone makes no term significant.
    """
    spoken = entities.filter("rest IS NOT NULL").select("key", F.xxhash64("rest", F.transform("base", lambda s: s["value"])).alias("copy"), "rest")
    once = stage(spoken.groupBy("copy").agg(F.min("key").alias("key")), "once")
    holders = held.join(once, ["copy", "key"], "left_semi").groupBy("entity").agg(F.count(F.lit(1)).alias("c_entity"))
    # What fewer texts hold stays below the threshold, whatever the term.
    holders = stage(holders.filter(discount(F.col("c_entity"), F.col("c_entity")) >= GENERALISE), "holders")
    terms = stage(spoken.join(once, ["copy", "key"], "left_semi").groupBy("copy").agg(F.first("rest").alias("rest")).select("copy", F.explode(_terms(F.col("rest"))).alias("term")), "terms")
    strong = held.join(once, ["copy", "key"], "left_semi").select("copy", "entity").distinct().join(holders.select("entity"), "entity")
    pairs = terms.join(strong, "copy").groupBy("entity", "term").agg(F.count(F.lit(1)).alias("c_both"))
    # A single common text is discounted to less than half.
    pairs = stage(pairs.filter(F.col("c_both") / (F.col("c_both") + 1) > GENERALISE), "pairs")
    plain = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = df.filter(~plain.rlike(HINT)).select(F.explode(_terms(plain)).alias("term")).unionByName(terms.select("term"))
    # Counted first, so what meets the candidates is one row per word and not one per document. An
    # inner join stays above the count; a semi-join would be moved below it.
    wanted = pairs.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(words.groupBy("term").agg(F.count(F.lit(1)).alias("c_term")).join(wanted, "term"), "counts")
    total = df.filter(~plain.rlike(HINT)).count() + once.count()
    weighed = attach(pairs, counts, "term", "n").join(holders, "entity")
    weighed = weighed.select("entity", "term", share(F.lit(total), "c_both", "c_term", "c_entity").alias("share"))
    return stage(weighed.filter(F.col("share") >= GENERALISE), "disclosing")


def discount(both: Column, least: Column) -> Column:
    """How far an estimate from so many common texts, and texts of the rarer side, is believed."""
    return both / (both + 1) * least / (least + 1)


def share(total: Column, both: str, term: str, entity: str) -> Column:
    """Discounted mutual information of term and entity as a share of the entity's information; 0 if it has none."""
    n = total.cast("double")
    own = F.log2(n / F.col(entity))
    told = F.log2(n * F.least(F.col(both), F.col(term)) / (F.col(term) * F.col(entity))) / own
    return F.when(own > 0, told * discount(F.col(both), F.least(F.col(term), F.col(entity)))).otherwise(0.0)


def all_spans(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``doc_id``, ``base``, ``terms``) per row: base spans and those of disclosing terms.

    Spans are (kind, start, end, value) in code points, end exclusive; ``terms`` have kind ``term`` and
    as value ``remove`` or what they are generalised to, ``name`` or ``term``. A null or empty text has none. Repeated rows
    come out repeated. Other columns are not read.
    """
    entities = found(df, doc_id, text)
    held = holdings(entities)
    gone = disclosing(df, entities, held, text)
    none = F.array().cast(KIND_SPAN)
    spoken = entities.filter("size(base) > 0").select("key", F.explode(_terms(F.col("rest"))).alias("term")).distinct()
    pair = F.concat_ws("\n", "entity", "term").alias("pair")
    meant = stage(spoken.join(gone.select("term").distinct(), "term", "left_semi").join(held.select("key", "entity"), "key").select("key", "term", pair), "meant")
    facts = stage(meant.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).join(gone.select(pair, "share"), "pair"), "facts")
    hits = attach(meant, facts, "pair", "n").filter("share IS NOT NULL").groupBy("key", "term").agg(F.max("share").alias("share"))
    lists = hits.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("list"))

    def span(m: Column) -> Column:
        name = F.when(m["value"].rlike(r"^\p{Lu}"), "name").otherwise("term")
        action = F.when(F.element_at("list", F.lower(m["value"])) >= REMOVE, "remove").otherwise(name)
        return F.struct(F.lit("term").alias("kind"), m["start"].alias("start"), m["end"].alias("end"), action.alias("value"))

    listed = F.filter(matches(F.col("rest"), TERM), lambda m: F.map_contains_key("list", F.lower(m["value"])))
    rows = entities.join(lists, "key", "left").withColumn("terms", F.when(F.col("list").isNull(), none).otherwise(F.transform(listed, span)))
    return rows.select("key", "doc_id", "base", "terms")


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def by_start(spans: Column | str) -> Column:
    """Spans by start, longer ones first."""
    order = lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"])
    return F.array_sort(spans, lambda a, b: F.signum(order(a, b)).cast("int"))


def replaced(text: Column, spans: Column, label) -> Column:
    """A text with its spans, sorted by start, replaced by ``label`` of what is done so far and the span."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        kept = F.substring(text, (a["at"] + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], kept, label(a, s)).alias("out"))

    return F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))


def sanitised(text: Column, spans: Column) -> Column:
    """A text with its spans, sorted by start, replaced by ``[KIND]``, terms by ``[NAME]`` or ``[TERM]``.

    Removed terms leave nothing, and of spans that overlap the first stands for both.
    """

    def label(a: Column, s: Column) -> Column:
        broader = F.when(s["kind"] == "term", s["value"]).otherwise(s["kind"])
        gone = (s["start"] < a["at"]) | ((s["kind"] == "term") & (s["value"] == "remove"))
        return F.when(gone, "").otherwise(F.concat(F.lit("["), F.upper(broader), F.lit("]")))

    return replaced(text, spans, label)


def op7_pii_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of every document."""
    rows = all_spans(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "terms")).alias("spans"),
        F.size("terms").cast("bigint").alias("n_terms"),
    )


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts with personal data and disclosing terms replaced; n_chars follows the text.

    Texts without a hint of personal data pass by without a join.
    """
    key, spans = fresh(docs, "key"), fresh(docs, "spans")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    hinted = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    rows = all_spans(docs)
    wanted = rows.filter("size(base) > 0").groupBy("key").agg(F.first(by_start(F.concat("base", "terms"))).alias(spans)).withColumnRenamed("key", key)
    joined = docs.filter(hinted).withColumn(key, text_key(docs)).join(wanted, key, "left")
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(sanitised(F.col("text"), F.col(spans)))
    changed = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return changed.select(*columns).unionByName(docs.filter(~hinted).select(*columns))
