"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text. The ledger stores the measurements and one failure bit per
rule; a policy is a versioned mask of rules, so applying another policy, or finding out what a rule
removes that no other does, needs only the stored bits and no text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from batchwarden.llm.common import WORD, fresh, table

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50

# Rules in bit order; each is an SQL condition over the measurements that marks a failing text.
# The first two are the base rules and belong to every policy.
RULES = {
    "too_few_words": f"n_words < {MIN_WORDS}",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 14 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines",
    "few_letters": "2 * n_letters < word_chars",
    "shouting": "2 * n_capitals > n_letters",
    "exclamations": "10 * n_exclamations > n_words",
}
BASE = ("too_few_words", "repeated_windows")
BIT = {name: 1 << k for k, name in enumerate(RULES)}

@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        """The bits of the chosen rules and of the base rules."""
        return reduce(lambda m, name: m | BIT[name], {*BASE, *self.rules}, 0)


POLICIES = {
    "base": Policy("base", ()),
    "v1": Policy("v1", ("symbols", "duplicate_lines", "few_letters")),
    "v2": Policy("v2", tuple(RULES)),
}
CURRENT = "v2"


def _count(text: Column, characters: str) -> Column:
    """How many of the characters a text holds."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and give it to ``body``, inside a single expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs more than once.

    Sorting (hash, place) brings equal windows together, so the work is n log n for any text.
    """
    none = F.lit(0).cast("bigint")

    def repeats(pairs: Column) -> Column:
        def place(x: Column, j: Column) -> Column:
            before, after = F.get(pairs, j - 1)["h"], F.get(pairs, j + 1)["h"]
            return F.when((x["h"] == before) | (x["h"] == after), x["i"])

        return F.sort_array(F.filter(F.transform(pairs, place), lambda i: i.isNotNull()))

    def length(places: Column) -> Column:
        gaps = F.transform(places, lambda i, k: F.least(i - F.get(places, k - 1), F.lit(WINDOW)))
        return F.aggregate(gaps, none, lambda total, gap: total + F.coalesce(gap, F.lit(WINDOW)))

    pairs = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    any_repeat = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(any_repeat, _let(pairs, lambda p: _let(repeats(p), length))).otherwise(none)


def _repeated_words(words: Column) -> Column:
    """Words covered by windows of three words that occur more than once in the array.

    Windows are compared by the 64-bit hash of their words' 64-bit hashes.
    """

    def of_words(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(h) - WINDOW)
        windows = F.transform(places, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW))))
        return _let(windows, _covered)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) >= WINDOW, _let(hashes, of_words)).otherwise(F.lit(0).cast("bigint"))


def _measured() -> dict[str, Column]:
    """The measurements over the struct ``_m`` of a text, its words, its lines with a word, and its non-letters."""
    text, words, lines, rest = (F.col(f"_m.{c}") for c in ("text", "words", "lines", "rest"))
    return {
        "n_words": F.size(words),
        "word_chars": F.length(text) - _count(rest, SPACES),
        "n_symbols": _count(rest, SYMBOLS),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeated_words(words),
        "n_letters": F.length(text) - F.length(rest),
        "n_capitals": F.length(F.regexp_replace(text, r"\P{Lu}+", "")),
        "n_exclamations": _count(rest, "!"),
    }


def with_ledger(df: DataFrame, text: str = "text", ledger: str = "ledger") -> DataFrame:
    """``df`` with one more struct column: every measurement (long) and ``bits`` (long).

    A null text counts as an empty one. All other columns, whatever their names, pass unchanged;
    ``ledger`` must be a name that ``df`` does not use. Repeated rows are measured each on its own.
    """
    source = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_source")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    parts = F.struct(
        body.alias("text"),
        F.regexp_extract_all(body, F.lit(f"({WORD})"), F.lit(0)).alias("words"),
        F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        F.regexp_replace(body, r"\p{L}+", "").alias("rest"),
    )
    packed = df.select(source, parts.alias("_m"))
    facts = packed.select("_source", *(c.cast("bigint").alias(name) for name, c in _measured().items()))
    bits = reduce(lambda a, b: a.bitwiseOR(b), (F.when(F.expr(rule), BIT[name]).otherwise(0) for name, rule in RULES.items()))
    names = facts.columns[1:]
    return facts.select(
        *(F.col("_source").getField(c).alias(c) for c in df.columns),
        F.struct(*names, bits.cast("bigint").alias("bits")).alias(ledger),
    )


def accepted(bits: Column, policy: Policy) -> Column:
    """Whether a text passes every rule of a policy."""
    return bits.bitwiseAND(F.lit(policy.mask)) == 0


def ablation(bits: DataFrame, policy: Policy, column: str = "bits") -> DataFrame:
    """Per rule of a policy: texts failing it, failing it alone, and kept were it switched off.

    Ledger bits are counted first, so whatever the number of texts, at most 2^rules patterns are
    left when the rules are compared.
    """
    patterns = bits.groupBy(F.col(column).bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = [name for name in RULES if BIT[name] & policy.mask]
    one = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(BIT[name]).cast("bigint").alias("bit")) for name in rules))
    each = patterns.select("bits", "n", F.explode(one).alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    rest = F.col("bits").bitwiseAND(F.lit(policy.mask).cast("bigint").bitwiseXOR(F.col("bit")))
    count = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")
    return each.groupBy("rule").agg(
        count(hit).alias("n_failed"),
        count(hit & (rest == 0)).alias("n_failed_alone"),
        count(rest == 0).alias("n_kept_without"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document, and the verdict of the current policy."""
    docs = table(spark, sf_dir, "documents")
    name = fresh(docs, "ledger")
    rows = with_ledger(docs, ledger=name).select("doc_id", f"{name}.*")
    base = sum(BIT[rule] for rule in BASE)
    return rows.withColumn("base_failed", F.col("bits").bitwiseAND(F.lit(base)) != 0).withColumn(
        "kept", accepted(F.col("bits"), POLICIES[CURRENT])
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the current policy accepts, with their own columns."""
    name = fresh(docs, "ledger")
    kept = with_ledger(docs, ledger=name).filter(accepted(F.col(f"{name}.bits"), POLICIES[CURRENT]))
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
