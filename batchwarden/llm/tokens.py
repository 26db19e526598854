"""Token ids of whole texts, with the work for repeated pieces done once per Python worker.

The tokenizers here split a text before white space and never merge across those places, so the ids
of a text are the ids of its pieces in order. A worker keeps the ids of the pieces it has met, up to
MEMO_PIECES, and asks the tokenizer only for new ones. They also part letters from the marks that follow
them, so a new word with marks at its end has the ids of the word without them, then those of the marks.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from batchwarden.llm.common import forget, memos

# White space as the tokenizers' patterns know it; Python's own class also holds \x1c to \x1f.
SPACE = "\t-\r \x85\xa0  -     　"
# Pieces of a text: a run of other characters with the one space or line break before it, or white
# space up to that.
PIECES = re.compile(f"[ \n][^{SPACE}]+|[^{SPACE}]+|[{SPACE}]+(?=[{SPACE}][^{SPACE}])|[{SPACE}]+")
WORDS = re.compile(f"[^{SPACE}]+")
# What Python's own splitting takes for white space besides.
SEPARATORS = re.compile("[\x1c-\x1f]")
# Letters below this one are letters to every version of Unicode in use here.
NEWER_LETTERS = "\u0530"
# Stands between pieces encoded in one call; pieces that hold it are encoded on their own.
MARK = "\x00"
# At about 180 bytes each a full memo takes some 300 MB.
MEMO_PIECES = 1_600_000
# Pieces joined into one call of the tokenizer.
CALL_PIECES = 2000
# Piece length up to which it is worth keeping.
MEMO_LENGTH = 64


class Encoder:
    """Encodes texts with one tokenizer file."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # Texts that hold the name of a special token are encoded in one call: the name is a token of its
        # own there, and cuts what stands around it.
        names = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.named = re.compile("|".join(map(re.escape, names))) if names else None
        self.memo: dict[str, bytes] = {}
        spaced = len(self.tokenizer.encode(" ", add_special_tokens=False).ids) > 0
        self.pieces = PIECES if spaced else WORDS
        self.spaced = spaced
        # Which tokens begin with a space; the byte-level alphabet writes it so.
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[number for token, number in vocabulary.items() if token.startswith("Ġ")]] = True
        # Which tokens end a word, in vocabularies that write it so; words of letters hold one of them.
        self.closes = np.zeros(len(self.begins), bool)
        self.closes[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids[0]
        self.line = (self.tokenizer.encode("\n", add_special_tokens=False).ids or [-1])[0]

    def _split(self, text: str) -> list[str]:
        """The pieces of a text."""
        if self.spaced or SEPARATORS.search(text):
            return self.pieces.findall(text)
        return text.split()

    def _alone(self, pieces: list[str]) -> None:
        for piece, coded in zip(pieces, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)):
            self.memo[piece] = np.array(coded.ids, "<u4").tobytes()

    def _letters(self, piece: str) -> bool:
        """Whether a piece is letters (after one space, where that is a part of pieces) to any pattern, in any case."""
        word = piece[1:] if self.spaced and piece[:1] == " " else piece
        return word.isalpha() and (word.isascii() or max(word) < NEWER_LETTERS and word.lower().isalpha())

    def _learn(self, pieces: list[str]) -> None:
        """Put the ids of new pieces into the memo, those of letters and marks at their end from these parts."""
        whole, parted = [], []
        for piece in pieces:
            word = piece.rstrip(string.punctuation)
            if len(word) < len(piece) and self._letters(word) and (piece[0] == " " or not self.spaced):
                parted.append((piece, word, piece[len(word) :]))
            else:
                whole.append(piece)
        more = {x for _, *parts in parted for x in parts}.difference(self.memo, whole)
        self._learn_whole([*whole, *more])
        self.memo.update([(piece, self.memo[word] + self.memo[marks]) for piece, word, marks in parted])
        for piece in more:
            if len(piece) > MEMO_LENGTH:
                del self.memo[piece]

    def _learn_whole(self, pieces: list[str]) -> None:
        """Put the ids of new pieces into the memo, many pieces per call where their ids can be told apart.

        Pieces that begin with a space follow each other as they are, and tokens with a leading space
        show where each begins; of pieces that begin with a line break its token does. Where white space
        leaves no token, words of letters are told apart by the tokens that end a word, if there are such,
        and a mark goes between other pieces.
        """
        if self.spaced:
            lines = [p for p in pieces if p[0] == "\n" and not p.isspace()]
            self._together(lines, "".join, lambda ids: (starts := np.flatnonzero(ids == self.line), np.append(starts[1:], len(ids))))
            fit = [p[0] == " " and not p.isspace() for p in pieces]
        else:
            fit = [MARK not in p for p in pieces]
        self._alone([p for p, good in zip(pieces, fit) if not good and p not in self.memo])
        joined = [p for p, good in zip(pieces, fit) if good]
        if self.spaced:
            self._together(joined, "".join, lambda ids: (starts := np.flatnonzero(self.begins[ids]), np.append(starts[1:], len(ids))))
            return
        letters: list[str] = []
        if self.closes.any():
            plain = [p.isalpha() and (p.isascii() or p.lower().isalpha()) for p in joined]
            letters = [p for p, good in zip(joined, plain) if good]
            joined = [p for p, good in zip(joined, plain) if not good]
        self._together(letters, " ".join, lambda ids: (np.append(0, (ends := np.flatnonzero(self.closes[ids]) + 1)[:-1]), ends))
        self._together(
            joined, lambda part: f" {MARK} ".join(part) + f" {MARK}", lambda ids: (np.append(0, (ends := np.flatnonzero(ids == self.mark))[:-1] + 1), ends)
        )

    def _together(self, pieces: list[str], join: Callable[[list[str]], str], bounds: Callable[[np.ndarray], tuple]) -> None:
        """Learn pieces joined into texts, whose ids ``bounds`` parts again; where it cannot, one by one."""
        for at in range(0, len(pieces), CALL_PIECES):
            part = pieces[at : at + CALL_PIECES]
            ids = np.array(self.tokenizer.encode_batch_fast([join(part)], add_special_tokens=False)[0].ids, "<u4")
            starts, ends = bounds(ids)
            if len(ends) != len(part) or len(starts) != len(part):
                self._alone(part)
                continue
            raw = ids.tobytes()
            self.memo.update(zip(part, (raw[a:b] for a, b in zip((4 * starts).tolist(), (4 * ends).tolist()))))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as unsigned 32-bit integers."""
        if len(self.memo) > MEMO_PIECES:
            self.memo.clear()
        whole = {i: text for i, text in enumerate(texts) if self.named and self.named.search(text)}
        split = [[] if i in whole else self._split(text) for i, text in enumerate(texts)]
        new = list(set().union(*split).difference(self.memo))
        self._learn(new)
        ids = [np.frombuffer(b"".join(map(self.memo.__getitem__, pieces)), "<u4") for pieces in split]
        for i, text in whole.items():
            ids[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        for piece in new:
            if len(piece) > MEMO_LENGTH:
                del self.memo[piece]
        return ids


def encoder(name: str) -> Encoder:
    """This process's encoder for a file of the public tokenizers."""
    if name not in memos:
        forget()
        memos[name] = Encoder(public_tokenizers.path(name))
    return memos[name]


def map_ids(docs: DataFrame, tokenizer: str, schema: str, row: Callable[[np.ndarray], tuple], text: str = "text", texts: int = 256) -> DataFrame:
    """Per row of ``docs`` its columns but ``text``, then the values that ``row`` makes of its ids.

    A null text counts as an empty one. ``schema`` describes what ``row`` returns.
    """
    kept = [c for c in docs.columns if c != text]
    own = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`"))
    made_fields = list(to_arrow_schema(StructType.fromDDL(schema)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, texts):
                batch = whole.slice(at, texts)
                rows = [row(ids) for ids in coder.encode([t or "" for t in batch.column(len(kept)).to_pylist()])]
                made = [pa.array(column, field.type) for column, field in zip(zip(*rows), made_fields)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *made], [*kept, *(f.name for f in made_fields)])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[: len(kept)])
    return own.mapInArrow(run, f"{fields}, {schema}")
