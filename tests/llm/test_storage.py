"""Tokens, packing, coded files, archives, embeddings, pipeline: round trips and brute force on small tables."""

from __future__ import annotations

import functools
import gzip
import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from batchwarden.llm import embeddings, huffman, packing, sentencepiece, tokens, warc
from batchwarden.llm.components import components
from pyspark.sql import functions as F
from tokenizers import Tokenizer

ODD = [None, "", " ", "a  b", "a\n\nb \n c", "it's we'll", "ΑΣ é x ́y", "日本語 テスト", "<|endoftext|>", "a\x1cb \x1c", "😀 😀a", "long " * 9000, "tail \t"]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts with ids out of order, a repeated row and a null id."""
    rows = [((7 * i) % 13, t, "x") for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[3], (None, "no id", "x")], "doc_id bigint, text string, ids string")


@functools.cache
def plain(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def plain_ids(name, text):
    return plain(name).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_memo_changes_no_id(name):
    rng = random.Random(4)
    texts = [t or "" for t in ODD] + ["".join(rng.choice(" \n\t\x00\x1c\xa0aZé'.s1́日") for _ in range(rng.randint(1, 30))) for _ in range(1500)]
    texts += ["<|endoftext|>", "end  <|endoftext|> of\n<|startoftext|>text", "a<|endoftext|><|endoftext|> b", "<|END|> <|endoftext|"]
    coder = tokens.Encoder(public_tokenizers.path(name))
    assert [x.tolist() for x in coder.encode(texts)] == [plain_ids(name, t) for t in texts]
    assert [x.tolist() for x in coder.encode(texts[:20])] == [plain_ids(name, t) for t in texts[:20]]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_marks_after_letters_are_parted(name):
    rng = random.Random(6)
    letters = ["ab", "Ab", "é", "ÉÀ", "İx", "ΑΣ", "ж", "日本", "x́", "a1", "9", "don't", "²", "\u0870", "a" * 70, ""]
    marks = [".", ",", "...", "'", "'s", "''", "!?", "-", "_", "^", "`", "$&", "…", "\u0301", "<", "¨", ""]
    words = [w + m for w in letters for m in marks]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\n\n", "\t", "\x1c", "\x00 "]) for _ in range(40)) for _ in range(400)]
    coder = tokens.Encoder(public_tokenizers.path(name))
    assert [x.tolist() for x in coder.encode(texts)] == [plain_ids(name, t) for t in texts]
    assert max(map(len, coder.memo)) <= tokens.MEMO_LENGTH
    # A known word with known marks needs no further work of the tokenizer.
    coder.encode([" other .", ".", ",", " then,"])
    coder._together = coder._alone = lambda pieces, *rest: pieces and pytest.fail(f"{pieces} encoded again")
    assert coder.encode([" other, other. then."])[0].tolist() == plain_ids(name, " other, other. then.")


def test_code_lengths_are_optimal():
    counts = np.array([5, 0, 9, 1, 1, 30, 2, 2])
    heap = [(c, [i]) for i, c in enumerate(counts.tolist()) if c]
    cost = 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], a[1] + b[1]))
    lengths = huffman.code_lengths(counts)
    assert int((counts * lengths).sum()) == cost and lengths[1] == 0
    short = huffman.code_lengths(2 ** np.arange(12), 5)
    assert short.max() == 5 and sum(2.0 ** -int(x) for x in short) <= 1
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9), 3)


@pytest.mark.parametrize("size", [0, 1, 127, 128, 129, 5000])
def test_code_round_trip(size):
    ids = np.random.default_rng(size).geometric(0.01, size) % 4096
    book = huffman.CodeBook(huffman.code_lengths(np.bincount(ids, minlength=4096), 14))
    checkpoints, words = book.encode(ids)
    assert (book.decode(size, checkpoints, words) == ids).all()


def test_id_files(spark, docs):
    out = huffman.read(spark, huffman.write(docs)).collect()
    want = sorted(((r.doc_id, plain_ids(huffman.TOKENIZER, r.text) + [huffman.END]) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, len(r[1])))
    start, rows = 0, []
    for doc_id, ids in want:
        rows.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r)[:4] for r in out), key=lambda r: r[1]) == rows
    assert huffman.read(spark, huffman.write(docs.limit(0))).count() == 0


def test_packing(spark, docs):
    out = packing.packed_documents(docs).collect()
    assert len({r.doc_id for r in out}) == len({r.doc_id for r in docs.collect()})
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= packing.CAPACITY
    assert len(by_sequence) == -(-sum(r.length for r in out) // packing.CAPACITY)
    whole = [0, *plain_ids(packing.TOKENIZER, ODD[11]), packing.END][1:]
    mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in out if r.doc_id == (7 * 11) % 13)
    assert [m[3] for m in mine] == [zlib.crc32(np.array(whole[s : s + n], "<u4").tobytes()) for _, s, n, _ in mine]
    assert all(n == packing.CAPACITY for _, _, n, _ in mine[1:]) and sum(m[2] for m in mine) == len(whole)
    assert packing.packed_documents(docs.limit(0)).count() == 0


def test_shards_pack_everything(spark):
    rng = random.Random(1)
    rows = [(i, rng.randint(1, 40)) for i in range(500)]
    pieces = spark.createDataFrame(rows, "nr int, length bigint").coalesce(1)
    out = packing.pack(pieces, capacity=64, shard_pieces=100)
    assert sorted((r.nr, r.length) for r in out.collect()) == rows
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("s")).filter("s > 64").count() == 0


def test_crossover_keeps_every_piece():
    rng = random.Random(3)
    lengths = [rng.randint(1, 60) for _ in range(80)]
    one = packing.Packing(lengths, 64, []).insert(list(range(80)))
    other = packing.Packing(lengths, 64, []).insert(sorted(range(80), key=lengths.__getitem__, reverse=True))
    for _ in range(20):
        child = packing.cross(one, other, rng)
        assert sorted(p for b in child.bins for p in b) == list(range(80))
        assert all(sum(lengths[p] for p in b) <= 64 for b in child.bins)
    assert packing.evolve(lengths, 64, [one.places()], 1).fitness >= one.fitness


def cut_bins(n, capacity, seed):
    """Lengths that fill ``n`` bins but for very little, the shortest a twentieth of a bin."""
    rng = random.Random(seed)
    bins = []
    while len(bins) < n:
        cuts = sorted([0, capacity, *rng.sample(range(1, capacity), rng.choice((2, 3, 4)))])
        bins += [b] if min(b := [y - x for x, y in zip(cuts, cuts[1:])]) >= capacity // 20 else []
    return sorted((x - 2 * (k % 3 == 0) for k, x in enumerate(x for b in bins for x in b)), reverse=True)


@pytest.mark.parametrize("seed", range(3))
def test_search_saves_a_bin_where_best_fit_does_not(seed):
    """The genetic search goes on until it has saved the bin that the longest-first start takes too many."""
    lengths = cut_bins(100, 2048, seed)
    start = packing.Packing(lengths, 2048, []).insert(list(range(len(lengths))))
    best = packing.evolve(lengths, 2048, [], 1)
    assert len(start.bins) > len(best.bins) == -(-sum(lengths) // 2048) == 100
    assert sorted(p for b in best.bins for p in b) == list(range(len(lengths)))
    assert best.left == [2048 - sum(lengths[p] for p in b) for b in best.bins] and min(best.left) >= 0


def test_bins_are_filled_by_the_longest_pieces_that_fit():
    rng = random.Random(4)
    for _ in range(200):
        lengths = sorted((rng.randint(1, 30) for _ in range(rng.randint(0, 8))), reverse=True)
        space = rng.randint(0, 60)
        sums = {sum(x for k, x in enumerate(lengths) if s >> k & 1) for s in range(1 << len(lengths))}
        found = packing.fullest(lengths, space)
        assert found == sorted(set(found)) and sum(lengths[k] for k in found) == max(x for x in sums if x <= space)
    assert packing.fullest([5, 3, 2, 2, 1], 5) == [0]


PAGES = [
    (1, "http://a.example.com/x", "<p>same</p>"),
    (2, "http://b.example.com/y?q=1", "<p>same</p>"),
    (3, None, None),
    (4, "not a url", ""),
    (5, "http://a.example.com/x", "é" * 200_000),
    (6, "http://a.example.com/x\r\nEvil: 1", "<p>same</p>"),
    (7, "http://[bad", "\r\n\r\nWARC/1.1"),
]


def test_archive_round_trip(spark):
    pages = spark.createDataFrame([*PAGES, PAGES[0]], "page_id bigint, url string, html string")
    archive = warc.write(pages)
    out = {}
    for r in warc.read(archive, warc.lookup(archive, pages.select("url"))).collect():
        out.setdefault(r.page_id, []).append(r)
    firsts = {}
    for page_id, _, body in PAGES:
        firsts.setdefault(body or "", page_id)
    assert len(out[1]) == 2
    for page_id, _, body in PAGES:
        first = firsts[body or ""]
        want = (len((body or "").encode()), warc.digest((body or "").encode()), "response" if first == page_id else "revisit", None if first == page_id else first)
        assert {tuple(r)[1:] for r in out[page_id]} == {want}
    one = warc.lookup(archive, spark.createDataFrame([("http://A.example.com/x",), ("http://nowhere.org/",)], "url string")).collect()
    assert sorted(r.page_id for r in one) == [1, 1, 5]
    stream = b"".join(r.body for r in archive.table("segments").orderBy("archive", "segment").collect())
    assert gzip.decompress(stream).count(b"WARC-Type: ") == 8
    empty = warc.write(pages.limit(0))
    assert warc.read(empty, warc.lookup(empty, pages.select("url"))).count() == 0


def test_rows_of_one_page_with_different_payloads_are_all_kept(spark):
    rows = [(1, "u", "a"), (2, "u", "a"), (2, "u", "bbb"), (None, "u", "a"), (3, "v", "bbb")]
    archive = warc.write(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    urls = spark.createDataFrame([("u",), ("v",)], "url string")
    got = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read(archive, warc.lookup(archive, urls)).collect()]
    want = [(1, 1, "response", None), (2, 1, "revisit", 1), (2, 3, "response", None), (None, 1, "response", None), (3, 3, "revisit", 2)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id bigint, url string, html string")
    archive = warc.write(pages, min_bytes=5)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read(archive, warc.lookup(archive, pages)).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_lookup_over_many_blocks(spark):
    pages = spark.range(1500).select(F.col("id").alias("page_id"), F.when(F.col("id") < 900, "http://hot.org/").otherwise(F.concat(F.lit("http://h.org/"), "id")).alias("url"), F.col("id").cast("string").alias("html"))
    archive = warc.write(pages)
    assert warc.lookup(archive, pages.select("url")).select("page_id").distinct().count() == 1500
    assert warc.lookup(archive, pages.filter("page_id = 0").select("url")).count() == 900


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randint(0, 90), rng.randint(0, 90)) for _ in range(40)]
    parent = {}
    for a, b in edges:
        for x in (a, b):
            parent.setdefault(x, x)

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert all(got.get(x, x) == find(x) for x in parent)


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 24))
    points = [centres[i % 12] + 0.25 * rng.standard_normal(24) for i in range(700)]
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(1000, rows[0][1]), (1001, [2 * x for x in rows[0][1]]), (1002, None), (1003, []), (1004, [0.0] * 24), (1005, [float("nan")] * 24), (1006, [None] + rows[0][1][1:]), (1007, [1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    able = [(i, np.array(v)) for i, v in rows if v and len(v) == 24 and None not in v and np.isfinite(v).all() and any(v)]
    matrix = np.array([v / np.linalg.norm(v) for _, v in able])
    near = matrix @ matrix.T >= 0.9
    np.fill_diagonal(near, False)
    names = np.array([i for i, _ in able])
    labels = names.copy()
    while True:
        new = np.array([min(labels[k], labels[near[k]].min(initial=labels[k])) for k in range(len(names))])
        if (new == labels).all():
            break
        labels = new
    got = {r.vec_id: r for r in embeddings.near_duplicates(table).collect()}
    assert sum(got[i].n_links for i in names.tolist()) >= 0.99 * near.sum()
    assert all(got[i].n_links <= n for i, n in zip(names.tolist(), near.sum(axis=1)))
    assert sum(got[i].component_id == c for i, c in zip(names.tolist(), labels.tolist())) >= 0.99 * len(names)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(1002, 1008))
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


def test_chunks_count_each_link_once(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CHUNK", 8)
    rows = [(i, [1.0, 0.01 * i, 0.02]) for i in range(40)]
    out = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert {(r.n_links, r.component_id) for r in out} == {(39, 0)}


def test_sentencepiece_against_whole_search():
    known = sentencepiece.pieces()
    model = known.model
    scores = {known.names[i]: (i, model.get_score(i)) for i in range(len(known.names)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    for text in [t or "" for t in ODD[:11]] + ["a" * 300, "=" * 400, "an ordinary sentence, with words."]:
        whole = model.normalize(text).replace(" ", sentencepiece.MARK) if text else ""
        best = [(0.0, 0, [])] + [(-1e30, 0, [])] * len(whole)
        for end in range(1, len(whole) + 1):
            for begin in range(max(0, end - known.longest), end):
                hit = scores.get(whole[begin:end])
                if hit and best[begin][0] + hit[1] > best[end][0]:
                    best[end] = (best[begin][0] + hit[1], begin, [hit[0]])
            if whole[end - 1] not in scores and best[end - 1][0] + known.unknown > best[end][0]:
                best[end] = (best[end - 1][0] + known.unknown, end - 1, known._other(whole[end - 1]))
        ids, end = [], len(whole)
        while end:
            ids, end = best[end][2] + ids, best[end][1]
        got = np.frombuffer(known.encode(text), "<i4")
        assert got.tolist() == ids
        assert known.decode(got) == text


def test_sentencepiece_tables(spark, docs):
    rows = docs.select("doc_id", "text", F.lit("mine").alias("extra"))
    back = sentencepiece.decode(sentencepiece.encode(rows))
    assert sorted((r.text for r in back.collect())) == sorted(t.text or "" for t in docs.collect())
    assert sentencepiece.decode(sentencepiece.encode(rows.limit(0))).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    made = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, made, folder)
        assert made.columns == docs.columns
        made = spark.createDataFrame(made.collect(), docs.schema)
    assert 0 < made.count() < docs.count()
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in made.collect()}
