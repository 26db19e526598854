"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search keeps the best path to each of the last few positions, as many as the longest piece has
characters. As soon as no piece spans a position, or the back-pointer paths of all positions in the
window run through one, everything before it is committed and forgotten. What lies between two such
boundaries does not depend on its surroundings, so a worker remembers the ids of words it has met.
New words that are short enough to need no commit but between pieces are searched side by side.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F

from batchwarden.llm.common import table

MODEL = "piece_bpe_32k.model"
MARK = "▁"  # stands for a space inside pieces
UNKNOWN_PENALTY = 10.0
MEMO_WORDS = 250_000  # in each of two generations
TEXTS = 256
# Longest word that is remembered, and words searched at a time.
SHORT = 64
CHUNK = 4096


class Pieces:
    """A model's pieces as a trie, with their scores."""

    def __init__(self, path: str) -> None:
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.longest = max(len(self.names[i]) for i in plain)
        self.unknown = min(model.get_score(i) for i in plain) - UNKNOWN_PENALTY
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.unknown_id = model.unk_id()
        # Tries are made where texts are encoded, as decoding needs none.
        self.plain = plain
        self.keys: np.ndarray | None = None
        # Whether a word mark can only begin a piece or follow other marks, so that words part there.
        self.words_part = not any(MARK in name.lstrip(MARK) for name in (self.names[i] for i in plain))
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.coded = [i.to_bytes(4, "little") for i in range(size)]
        values = {number: value for value, number in self.bytes.items()}
        silent = {i for i in range(size) if model.is_control(i) or model.is_unknown(i)}
        self.outputs = [bytes([values[i]]) if i in values else b"" if i in silent else self.names[i].replace(MARK, " ").encode() for i in range(size)]

    @cached_property
    def trie(self) -> dict[str, list]:
        """What begins pieces. A node: what follows by character, the id of the piece that ends here (-1: none), its score."""
        trie: dict[str, list] = {}
        for i in self.plain:
            following, node = trie, None
            for character in self.names[i]:
                node = following.setdefault(character, [{}, -1, 0.0])
                following = node[0]
            node[1:] = i, self.model.get_score(i)
        return trie

    def _number_trie(self, plain: list[int]) -> None:
        """The trie as arrays: nodes by number, what follows them in a table of hashed (node, character)."""
        nodes, steps = {"": 0}, []
        for name in (self.names[i] for i in plain):
            for k in range(1, len(name) + 1):
                if name[:k] not in nodes:
                    nodes[name[:k]] = len(nodes)
                    steps.append((nodes[name[: k - 1]] << 21 | ord(name[k - 1]), len(nodes) - 1))
        self.ends_here = np.full(len(nodes), -1, np.int32)
        self.ends_here[[nodes[self.names[i]] for i in plain]] = plain
        # Scores by id; the last is that of an unknown character.
        self.worths = np.full(len(self.names) + 1, self.unknown)
        self.worths[plain] = [self.model.get_score(i) for i in plain]
        self.bits = max(4, len(steps).bit_length() + 2)
        self.keys, self.following = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        for key, node in steps:
            at = int(self._slots(np.array([key], np.int64))[0])
            while self.keys[at] >= 0:
                at = (at + 1) % len(self.keys)
            self.keys[at], self.following[at] = key, node

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _follow(self, nodes: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """The nodes that follow by a character, -1 where none does."""
        wanted = nodes.astype(np.int64) << 21 | characters
        at = self._slots(wanted)
        found = self.keys[at]
        open_ = np.flatnonzero((found != wanted) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.keys)
            found[open_] = self.keys[at[open_]]
            open_ = open_[(found[open_] != wanted[open_]) & (found[open_] >= 0)]
        return np.where(found == wanted, self.following[at], -1)

    def _search(self, words: list[str]) -> list[bytes]:
        """The ids of words of up to SHORT characters, longest first, as ``stream`` finds them: all take a step together."""
        if self.keys is None:
            self._number_trie(self.plain)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths + 1) - lengths - 1
        total = int(starts[-1] + lengths[-1]) + 1
        own = np.arange(int(lengths.sum())) + np.repeat(np.arange(len(words)), lengths)
        characters = np.full(total, (1 << 21) - 1, np.int64)  # between words, what no piece holds
        characters[own] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        # All pieces in the words: where they begin, their lengths and ids, and where the furthest one ends.
        covered, furthest = np.zeros(total, bool), np.arange(1, total + 1)
        live, nodes, found = own, np.zeros(len(own), np.int32), []
        for length in range(1, self.longest + 1):
            nodes = self._follow(nodes, characters[live + length - 1])
            live, nodes = live[nodes >= 0], nodes[nodes >= 0]
            ending = self.ends_here[nodes]
            ended, ending = live[ending >= 0], ending[ending >= 0]
            found.append((ended, np.full(len(ended), length), ending))
            furthest[ended] = ended + length
            if length == 1:
                covered[ended] = True
        others = own[~covered[own]]
        found.append((others, np.ones(len(others), np.int64), np.full(len(others), len(self.names), np.int32)))
        begin, length, piece = map(np.concatenate, zip(*found))
        offset = (np.arange(total) - np.repeat(starts, lengths + 1)).astype(np.int16)[begin]
        order = np.argsort(offset, kind="stable")
        begin, piece, end = begin[order], piece[order], (begin + length)[order]
        worth = self.worths[piece]
        steps = np.cumsum([0, *np.bincount(offset)]).tolist()
        scores = np.full(total, -np.inf)
        scores[starts] = 0.0
        begins, numbers = np.zeros(total, np.int64), np.zeros(total, np.int64)
        reached = np.zeros(len(words), np.int64)
        for at, (low, high) in enumerate(zip(steps, steps[1:])):
            here = starts[: int(np.searchsorted(-lengths, -at, "left"))] + at
            reached = reached[: len(here)]
            # No piece spans these places: what comes before is certain.
            scores[here[reached <= here]] = 0.0
            np.maximum(reached, furthest[here], out=reached)
            # Pieces that begin at one place end at different ones.
            score = scores[begin[low:high]] + worth[low:high]
            better = low + np.flatnonzero(score > scores[end[low:high]])
            to = end[better]
            scores[to], begins[to], numbers[to] = score[better - low], begin[better], piece[better]
        chosen = np.full(total, -1, np.int64)
        at, left = starts + lengths, starts
        while len(at := at[(more := at > left)]):
            left = left[more]
            chosen[at] = numbers[at]
            at = begins[at]
        path = np.flatnonzero(chosen >= 0)
        word = np.searchsorted(starts, path, "right") - 1
        ends = np.cumsum(np.bincount(word, minlength=len(words)))
        raw = chosen[path].astype("<u4").tobytes()
        bounds = [0, *(4 * ends).tolist()]
        made = [raw[a:b] for a, b in zip(bounds, bounds[1:])]
        for k in np.unique(word[chosen[path] == len(self.names)]).tolist():
            made[k] = self._path_of(words[k], chosen[starts[k] + 1 : starts[k] + 1 + lengths[k]])
        return made

    def _path_of(self, word: str, chosen: np.ndarray) -> bytes:
        """The ids of a path with unknown characters, from the id that ends at each place (-1: none)."""
        numbers = [(k, i) for k, i in enumerate(chosen.tolist()) if i >= 0]
        found = [[i] if i < len(self.names) else self._other(word[k]) for k, i in numbers]
        return b"".join(self.coded[i] for run in found for i in run)

    def _other(self, character: str) -> list[int]:
        """The ids of a character that no piece covers."""
        if not self.bytes:
            return [self.unknown_id]
        return [self.bytes[b] for b in character.encode("utf-8", "replace")]

    def stream(self, text: str) -> Iterator[list[int]]:
        """Ids of a normalised text in runs, each as soon as it is certain."""
        best: dict[int, tuple[float, int, int]] = {0: (0.0, -1, -1)}  # end: score, begin, id (-1: unknown)
        base = reach = 0
        trie, longest, unknown = self.trie, self.longest, self.unknown
        for at in range(len(text)):
            here = best.get(at)
            if here is None:
                continue
            if reach <= at and at > base:
                yield self._path(text, best, base, at)
                best, base = {at: (0.0, -1, -1)}, at
                here = best[at]
            elif at - base >= 4 * longest and at % longest == 0:
                common = self._common(best, base, at)
                if common > base:
                    yield self._path(text, best, base, common)
                    best, base = {k: v for k, v in best.items() if k >= common}, common
            score, following, end, covered = here[0], trie, at, False
            for character in text[at : at + longest]:
                node = following.get(character)
                if node is None:
                    break
                end += 1
                following, number, worth = node
                if number >= 0:
                    covered = covered or end == at + 1
                    known = best.get(end)
                    if known is None or score + worth > known[0]:
                        best[end] = (score + worth, at, number)
                    if end > reach:
                        reach = end
            if not covered:
                known = best.get(at + 1)
                if known is None or score + unknown > known[0]:
                    best[at + 1] = (score + unknown, at, -1)
                reach = max(reach, at + 1)
        if len(text) > base:
            yield self._path(text, best, base, len(text))

    def _path(self, text: str, best: dict, base: int, end: int) -> list[int]:
        out: list[list[int]] = []
        while end > base:
            _, begin, number = best[end]
            out.append([number] if number >= 0 else self._other(text[begin:end]))
            end = begin
        return [number for run in reversed(out) for number in run]

    def _common(self, best: dict, base: int, at: int) -> int:
        """The last boundary that the paths of all open positions share."""
        open_ends = [k for k in best if k >= at]
        paths = []
        for end in open_ends:
            path = set()
            while end > base:
                path.add(end)
                end = best[end][1]
            paths.append(path)
        shared = set.intersection(*paths) if paths else set()
        return max((k for k in shared if k <= at), default=base)

    def _words(self, text: str) -> list[str]:
        """The normalised words of a text."""
        whole = self.model.normalize(text).replace(" ", MARK) if text else ""
        if not self.words_part:
            return [whole] if whole else []
        # A word begins at a mark that follows another character; runs of marks stay together.
        parts = whole.split(MARK)
        if "" not in parts[1:]:
            return ([parts[0]] if parts[0] else []) + [MARK + part for part in parts[1:]]
        words, marks = [], ""
        for k, part in enumerate(parts):
            marks += MARK if k else ""
            if part:
                words.append(marks + part)
                marks = ""
        return words + ([marks] if marks else [])

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        split = [self._words(text) for text in texts]
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.older = {}, self.memo
        memo, older, coded = self.memo, self.older, self.coded
        new = set().union(*split).difference(memo)
        again = new.intersection(older)
        memo.update((word, older[word]) for word in again)
        limit = min(SHORT, 4 * self.longest)  # up to which ``stream`` commits between pieces only
        new -= again
        short = sorted((word for word in new if len(word) <= limit), key=len, reverse=True)
        for at in range(0, len(short), CHUNK):
            part = short[at : at + CHUNK]
            memo.update(zip(part, self._search(part)))
        long = [word for word in new if len(word) > limit]
        for word in long:
            memo[word] = b"".join([coded[i] for run in self.stream(word) for i in run])
        out = [b"".join(map(memo.__getitem__, words)) for words in split]
        for word in long:
            if len(word) > SHORT:
                del memo[word]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the space that normalisation puts in front is taken off."""
        text = b"".join(map(self.outputs.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_loaded: dict[str, Pieces] = {}


def pieces(name: str = MODEL) -> Pieces:
    """This process's pieces of a model file."""
    if name not in _loaded:
        _loaded[name] = Pieces(public_tokenizers.path(name))
    return _loaded[name]


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``docs`` with the text replaced by ``ids``; null and empty texts have none. Other columns pass unchanged."""
    kept = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(model)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                coded = known.encode_all([t or "" for t in batch.column(len(kept)).to_pylist()])
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)])
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(coded), "<i4")))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], column], [*kept, ids])

    rows = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[: len(kept)])
    return rows.mapInArrow(run, f"{fields}`{ids}` array<int>")


def decode(coded: DataFrame, ids: str = "ids", text: str = "text", model: str = MODEL) -> DataFrame:
    """``coded`` with ``text``, what its ids stand for, and ``ids_crc32``; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(model)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                column = batch.column(ids).fill_null([])
                bounds = np.cumsum([0, *column.value_lengths().to_numpy()]).tolist()
                flat = column.flatten().to_numpy().astype("<u4")
                lists = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
                made = [pa.array([known.decode(v) for v in lists], pa.string()), pa.array([zlib.crc32(v.tobytes()) for v in lists], pa.int64())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, text, "ids_crc32"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields)
    return coded.mapInArrow(run, f"{fields}, `{text}` string, ids_crc32 bigint")


def op2_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded from its ids again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("source"), "text")
    back = decode(encode(docs))
    return back.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids_crc32", F.length("text").cast("bigint").alias("n_chars"), (F.col("text") == F.col("source")).alias("restored"), "ids")
