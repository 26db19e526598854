"""Words that are encoded many at a time, against the same words on their own."""

from __future__ import annotations

import random
import zlib

import numpy as np

from batchwarden.llm import sentencepiece, tokens

ODD = [
    "İstanbul kalabalık don't I'M ǅ ﬁne", "a\x1cb c\x1fd plain", "x\x00y z", "é é", "中文 字 кот Ёлка", "<|endoftext|> hi there",
    "ŉ ß ẞ ΑΣ Ⅷ ª", "", " ", "𐐀𐐨 𑀅", "a_b 1a a1 12 ²",
]


def test_words_searched_together_are_those_of_the_stream():
    known = sentencepiece.pieces()
    draw = random.Random(3)
    letters = "aaeeinorst kмы中🙂\x00'1" + sentencepiece.MARK
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(1, sentencepiece.SHORT))) for _ in range(3000)}
    words |= {sentencepiece.MARK + w for w in ("the", "international", "кошка", "e" * 60)}
    words = sorted(words, key=len, reverse=True)
    wanted = [b"".join(known.coded[i] for run in known.stream(w) for i in run) for w in words]
    assert known._search(words) == wanted


def test_texts_are_encoded_alike_alone_and_together(monkeypatch):
    texts = [*ODD, "word " * 50, "e" * 500 + " tail", "a  b   c"]
    known = sentencepiece.Pieces(sentencepiece.public_tokenizers.path(sentencepiece.MODEL))
    streamed = []
    stream = known.stream
    monkeypatch.setattr(known, "stream", lambda text: streamed.append(text) or stream(text))
    together = known.encode_all(texts)
    # Only words too long to be remembered are searched one by one.
    assert all(len(word) > sentencepiece.SHORT for word in streamed) and not any(len(word) > sentencepiece.SHORT for word in known.memo)
    known.memo, known.older = {}, {}
    assert together == [known.encode(text) for text in texts]


def test_words_of_letters_are_learnt_without_marks():
    coder = tokens.Encoder(tokens.public_tokenizers.path("word_bpe_49k.json"))
    own, given = coder.tokenizer, []

    class Seen:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return own.encode_batch_fast(texts, **options)

        def __getattr__(self, name):
            return getattr(own, name)

    coder.tokenizer = Seen()
    words = ["alpha", "beta", "Straße", "кот", "中文", "don't", "12", "İzmir"]
    got = coder.encode([" ".join(words)])[0].tolist()
    assert got == own.encode(" ".join(words), add_special_tokens=False).ids
    assert any(set(text.split()) == {"alpha", "beta", "Straße", "кот", "中文"} for text in given)


def test_odd_texts_have_the_ids_of_the_library():
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        coder = tokens.Encoder(tokens.public_tokenizers.path(name))
        wanted = [coder.tokenizer.encode(text, add_special_tokens=False).ids for text in ODD]
        assert [ids.tolist() for ids in coder.encode(ODD)] == wanted


def test_ids_are_read_as_arrays_and_null_ids_are_none(spark):
    known = sentencepiece.pieces()
    texts = ["one two", "", "Straße 🙂 x", None]
    rows = [(k, [int(i) for i in np.frombuffer(known.encode(t), "<u4")] if t is not None else None) for k, t in enumerate(texts)]
    made = sentencepiece.decode(spark.createDataFrame(rows, "doc_id bigint, ids array<int>").coalesce(1)).orderBy("doc_id").collect()
    assert [r["text"] for r in made] == ["one two", "", "Straße 🙂 x", ""]
    assert [r["ids_crc32"] for r in made] == [zlib.crc32(np.array(ids or [], "<u4").tobytes()) for _, ids in rows]
    assert [r["ids"] for r in made] == [ids for _, ids in rows]
