"""Quality ledger, personal data, main text, SimHash and language model, against plain Python on small tables."""

from __future__ import annotations

import hashlib
import math
import re
import time
import zlib
from collections import Counter
from itertools import combinations

import pytest
import xxhash
from batchwarden.llm import html, language_model, pii, quality, simhash
from pyspark.sql import functions as F

DDL = "doc_id bigint, text string, ledger string, n int"
PROSE = "the quick brown fox jumps over the lazy dog and runs to the river bank "
TEXTS = [
    None,
    "",
    "  \n\t ",
    "one",
    "two words",
    PROSE * 6,
    PROSE * 6,
    "a\n\nb\n a\nb\nb\n" * 30,
    "x y z " * 40 + "x y",
    "word " * 70_000,
    "call +49 (30) 123-4567 or mail a.b+c@mail.example.org.x_y@z.de, 10.0.0.256 1.2.3.4.5 010.1.2.3",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and é 😀 +1 2 3 4 5 6 7",
    "@ a@b a@b.c@d.e " + "1" * 5000 + " " + "1 " * 3000,
    "Ünïcode ÄÖ non-breaking\x1cword #*$%&|<>!!",
]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts, a repeated row, a null id, one id with two texts, and columns named like the engine's."""
    rows = [(i, t, "mine", i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, (5, TEXTS[5], "mine", 5), (None, "no id at all", None, None), (3, "other text", "x", 1)], DDL)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def measures(text):
    words = words_of(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_ledger_measures(docs):
    out = quality.with_ledger(docs, ledger="own").select("doc_id", "text", "ledger", "own.*").collect()
    assert len(out) == docs.count()
    for row in out:
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == measures(row.text)
        assert bool(row.bits & 1) == (row.n_words < 50)


def test_ablation_counts_rules(spark):
    bits = spark.createDataFrame([(0,), (0,), (1,), (3,), (8,), (256,)], "bits bigint")
    out = {r.rule: r[1:] for r in quality.ablation(bits, quality.Policy("t", ("symbols",))).collect()}
    assert out == {"too_few_words": (2, 1, 4), "repeated_windows": (1, 0, 3), "symbols": (1, 1, 4)}


def test_stage_keeps_columns_and_good_texts(spark, docs):
    out = quality.keep_good(spark, docs, "")
    assert out.columns == docs.columns
    good = " ".join(f"w{'abcdefghij'[i % 10] * (1 + i % 7)}" for i in range(60))
    both = spark.createDataFrame([(1, good, "a", 1), (2, "# " * 60, "b", 2)], DDL)
    assert [r.doc_id for r in quality.keep_good(spark, both, "").collect()] == [1]
    assert quality.keep_good(spark, docs.limit(0), "").count() == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        each = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in each) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def test_base_spans(docs):
    out = pii.all_spans(docs.drop("n")).join(docs.select(pii.text_key(docs).alias("key"), "text").distinct(), "key")
    rows = out.select("text", pii._joined(F.col("base")).alias("spans")).collect()
    assert len(rows) == docs.count()
    for row in rows:
        want = [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, row.text or "") if valid(k, m[0])]
        assert row.spans == ",".join(want)


def brute_terms(rows):
    """Spans of disclosing terms per doc_id, from the definition, for texts whose only entities are e-mails."""
    parts = {i: (set(m[0].lower() for m in re.finditer(BASE["email"], t)), re.sub(BASE["email"], lambda m: " " * len(m[0]), t)) for i, t in rows}
    texts = {(t, i if not re.search(pii.HINT, t) else None): i for i, t in rows}.values()
    words = {i: {w.lower() for w in re.findall(r"[^\W\d_]{3,}", parts[i][1])} for i in parts}
    holders, terms, both = Counter(), Counter(), Counter()
    for i in texts:
        held = {*(f"email:{v}" for v in parts[i][0]), *(["email"] if parts[i][0] else [])}
        holders.update(held)
        terms.update(words[i])
        both.update((e, w) for e in held for w in words[i])
    n, out = len(texts), {}
    for i, _ in rows:
        held = {*(f"email:{v}" for v in parts[i][0]), *(["email"] if parts[i][0] else [])}
        share = {}
        for e, w in ((e, w) for e in held for w in words[i]):
            c, least = both[e, w], min(terms[w], holders[e])
            told = math.log2(n * c / (terms[w] * holders[e])) / math.log2(n / holders[e])
            share[w] = max(share.get(w, 0), told * c / (c + 1) * least / (least + 1))
        found = re.finditer(r"[^\W\d_]{3,}", parts[i][1])
        action = lambda m: "remove" if share[m[0].lower()] >= 0.75 else "name" if m[0][0].isupper() else "term"
        out[i] = [(m.start(), m.end(), action(m)) for m in found if share.get(m[0].lower(), 0) >= 0.5]
    return out


def test_disclosing_terms(spark):
    """Terms of one value, of a kind pooled, in copies, in compounds and far from the entity, against brute force."""
    lines = ["Zorblax agent reach me at z@x.org {} today", "agent zorblax of {} z@x.org", "for {} Anne-Zorblax write z@x.org"]
    rows = [(i, lines[i % 3].format("ab" + "cdefghijk"[i])) for i in range(9)]
    rows += [(100 + i, f"mail u{i}@site.org {'and so on ' * 30} our Helpdesk, today") for i in range(5)]
    rows += [(200 + i, "unique copied words k@copy.org") for i in range(50)]
    rows += [(300 + i, f"the agent went for a walk today {'unique' if i % 3 else ''}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: [(s.start, s.end, s.value) for s in r.terms] for r in pii.all_spans(docs).collect()}
    assert out == brute_terms(rows)
    texts = dict(rows)
    assert all("remove" in {v for a, b, v in out[i] if texts[i][a:b].lower() == "zorblax"} for i in range(9))
    assert {v for _, _, v in out[100]} == {"name", "term"}
    assert not any(out[i] for i in (*range(200, 250), *range(300, 500)))
    clean = {r.doc_id: r.text for r in pii.sanitise(spark, docs, "").collect()}
    assert not any("zorblax" in clean[i].lower() for i in range(9)) and "[NAME]" in clean[100] and clean[300] == texts[300]


def test_sanitise_updates_length_and_keeps_rows(spark):
    docs = spark.createDataFrame([(1, "to a@b.cd now", 13), (2, None, None), (3, "", 0), (1, "to a@b.cd now", 13)], "doc_id bigint, text string, n_chars bigint")
    out = sorted((r.doc_id, r.text, r.n_chars) for r in pii.sanitise(spark, docs, "").filter("doc_id != 2").collect())
    assert out == [(1, "to [EMAIL] now", 14)] * 2 + [(3, "", 0)]
    assert pii.sanitise(spark, docs.limit(0), "").count() == 0


def brute_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_simhash_fingerprints_and_copies(docs):
    rows = docs.filter("length(text) < 9000 OR text IS NULL")
    out = simhash.near_duplicates(rows)
    assert Counter(r.fingerprint for r in out.collect()) == Counter(f"{brute_fingerprint(r.text):016x}" for r in rows.collect())
    found = {r.doc_id: r.component_id for r in out.collect()}
    assert found[6] == found[5] == 5 and found[1] == found[2] == found[0] == 0 and found[None] is None
    assert simhash.near_duplicates(rows.limit(0)).count() == 0


@pytest.mark.parametrize("size", [3, 2000])
def test_covering_links_miss_nothing(spark, size, monkeypatch):
    """Small buckets by pairs, large ones by midpoints: the same components as all pairs."""
    monkeypatch.setattr(simhash, "SMALL_BUCKET", size)
    base = [xxhash.xxh64_intdigest(str(i)) for i in range(40)]
    values = {b ^ sum(1 << (xxhash.xxh32_intdigest(f"{b}{k}{j}") % 64) for j in range(k % 5)) & (2**64 - 1) for b in base for k in range(12)}
    values = sorted(values)
    parent = list(range(len(values)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in combinations(range(len(values)), 2):
        if (values[a] ^ values[b]).bit_count() <= 2:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    table = spark.createDataFrame([(simhash._signed(v), i) for i, v in enumerate(values)], "fp bigint, node bigint")
    got = {r.node: r.component for r in simhash.components(simhash.links(table)).collect()}
    assert [got.get(i, i) for i in range(len(values))] == [find(i) for i in range(len(values))]


def test_one_of_each(spark, docs):
    out = simhash.one_of_each(spark, docs, "")
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    assert 5 in kept and 6 not in kept and kept.count(5) == 1 and None in kept


def test_language_model(docs):
    known = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = {r.doc_id: (r.text or "").encode().lower().split() + [b""] for r in known.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in rows}
    counts = Counter(w for i, ws in rows.items() if not held[i] for w in ws)
    total = sum(counts.values())
    out = language_model.score(known).collect()
    assert len(out) == len(rows)
    for r in out:
        words = rows[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(words), sum(counts[w] > 0 for w in words), total)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in words))
        assert math.isfinite(r.score) and r.score < 0
    assert language_model.score(known.limit(0)).count() == 0
    assert language_model.score(docs).count() == docs.count()


def test_weights_are_learned(spark):
    """Where the next word follows from the last one, bigrams must earn the weight and beat the base."""
    cells = [(5, int(language_model._grid(__import__("numpy").array([0.5]))[0]), int(language_model._grid(__import__("numpy").array([0.01]))[0]), 900)]
    assert language_model.learn(cells, 1e-4)[5][0] > 0.95
    docs = spark.createDataFrame([(i, "a b c d e f g h " * 5) for i in range(60)], "doc_id bigint, text string")
    out = [r for r in language_model.score(docs).collect() if r.held_out]
    assert out and all(r.score > r.base_score / 2 for r in out)


def test_blocks_of_any_size_score_alike(docs):
    rows = docs.filter("doc_id IS NOT NULL")
    small = language_model.blocks(rows, size=40)
    assert small.count() > 5 and small.agg(F.sum("n_tokens")).first()[0] == language_model.blocks(rows).agg(F.sum("n_tokens")).first()[0]


LONG = "It is the story of a man and of the sea that he had to cross for the sake of his own family in the north. "
PAGE = f"""<html><head><title>T</title><style>p{{}}</style></head><body><header><a href=/>Home</a></header>
<nav><ul><li><a href="/a">A</a></ul></nav><div class="cookie-notice"><p>{LONG}</p></div><article><h1>Head &amp; line</h1>
<p>{LONG}<script>var x="</p>"</script></p><p>Short.<p>{LONG}&lt;b&gt;&nbsp;end</p><div id="comments"><p>{LONG}</p></div></article>
<aside>{LONG}</aside><form><p>{LONG}</p></form><footer>&copy; {LONG}</footer></body></html>"""


def test_html_rules():
    long = LONG.strip()
    assert html.main_text(PAGE) == "\n\n".join(["Head & line", long, "Short.", f"{long} <b> end"])
    plain = f"<div><div class=menu><a href=1>x</a></div><div><p>{LONG}</p><p>Short one.</p></div><div class='ad'>Buy</div></div>"
    assert html.main_text(plain) == f"{long}\n\nShort one."
    assert [html.main_text(x) for x in (None, "", "<p", "<<>>", "<script>x")] == ["", "", "", "", ""]
    assert len(html.main_text("<article><p>" + LONG * 3000)) > 300_000


def test_html_table(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (1, "u", PAGE)], "page_id bigint, url string, html string")
    out = html.extract(pages).collect()
    assert sorted(r.n_chars for r in out)[0] == 0 and len(out) == 3 and all(r.n_chars == len(r.text) for r in out)
    assert html.extract(pages.limit(0)).count() == 0


def test_sha_of_no_spans(docs):
    empty = hashlib.sha256(b"").hexdigest()
    rows = pii.all_spans(docs.filter("text IS NULL")).select(F.sha2(pii._joined(F.col("base")), 256).alias("s")).collect()
    assert [r.s for r in rows] == [empty]


@pytest.mark.parametrize("piece", ["<a ", '<a "', "<a 'x\" ", "<a<", "<div>", "<p hidden>", "<style></style ", "<!", "</a "])
def test_damaged_pages_take_linear_time(piece):
    def seconds(size):
        page = piece * (size // len(piece))
        begin = time.perf_counter()
        html.main_text(page)
        return time.perf_counter() - begin

    assert seconds(400_000) < 10


def test_tags_of_damaged_pages():
    assert [b.text for b in html.blocks('<p>a < b <i c="x>y">d</i> <p>e <a "f')] == ["a < b d", 'e <a "f']
    assert [b.text for b in html.blocks("<p>a<!-- <p>b --><p hidden>c</p>d<style>p{}</style><p>e<!-- f")] == ["a", "d", "e"]
    assert [b.linked for b in html.blocks("<p><a href='x'>four</a></p><p>none</p></a><p>none</p>")] == [4, 0, 0]


def test_own_text_columns_give_way(spark):
    rows = spark.createDataFrame([(1, "<p>a</p>", "old", 99)], "page_id bigint, html string, text string, n_chars int")
    assert [r.asDict() for r in html.extract(rows).collect()] == [{"page_id": 1, "text": "", "n_chars": 0}]
