"""Packing documents into sequences of fixed length by a grouping genetic algorithm on islands.

Documents are cut only where they are longer than a sequence. Pieces are dealt at random into shards
of bounded size, and every shard evolves on several islands, each a task of its own. A chromosome is
a whole packing and its genes are its bins: crossover injects some well-filled bins of one parent into
the other and drops the bins of the other that hold the same pieces. What these displace is put together
anew: each time the longest piece with those others that fill its bin, then the rest by best fit.
After every epoch each island hands its best packing to the next one. An island searches until many
generations have saved no bin. A shard that has reached its lower bound, total length over capacity,
stops at once: no packing of it has fewer bins.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from functools import partial
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from batchwarden.llm.common import stage, table
from batchwarden.llm.tokens import map_ids

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"
END = 0
SHARD_PIECES = 6000
ISLANDS = 3
EPOCHS = 2
POPULATION = 4
# An epoch ends after so many generations in which no bin was saved.
GENERATIONS = 60
# The share of the well-filled bins of a parent that crossover injects, on average.
INJECTED = 0.02
# The share of the loose bins that stay where crossover does not touch them.
KEPT_LOOSE = 0.2
# Pieces among which those are looked for that fill a bin.
CHOICE = 40
# A bin counts as well filled from this share of its capacity on.
WELL_FILLED = 0.998
NOISE = 0.05
PIECE = "array<struct<start:bigint,length:bigint,ids_crc32:bigint>>"


def cut(ids: np.ndarray, end: int = END, capacity: int = CAPACITY) -> tuple[list[dict]]:
    """The pieces of one document; only the first may be shorter than a sequence."""
    ids = np.append(ids, end).astype("<u4")
    first = len(ids) % capacity or capacity
    bounds = [0, *range(first, len(ids) + 1, capacity)]
    pairs = zip(bounds, bounds[1:])
    return ([{"start": a, "length": b - a, "ids_crc32": zlib.crc32(ids[a:b].tobytes())} for a, b in pairs],)


class Packing:
    """Bins over the pieces of a shard, open to best-fit insertion."""

    def __init__(self, lengths: list[int], capacity: int, bins: list[list[int]], left: list[int] | None = None) -> None:
        self.lengths, self.capacity, self.bins = lengths, capacity, bins
        self.left = [capacity - sum(map(lengths.__getitem__, b)) for b in bins] if left is None else left

    def insert(self, pieces: list[int]) -> "Packing":
        """Put each piece, in the given order, where it leaves the least space."""
        by_space: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        free = 0  # bit r: some bin has r left
        shortest = min(map(self.lengths.__getitem__, pieces), default=0)
        for k, space in enumerate(self.left):
            if space >= shortest:
                by_space[space].append(k)
                free |= 1 << space
        for piece in pieces:
            need = self.lengths[piece]
            above = free >> need
            if above:
                space = need + (above & -above).bit_length() - 1
                k = by_space[space].pop()
                if not by_space[space]:
                    free ^= 1 << space
                # Packings share their bins, so none is changed.
                self.bins[k] = [*self.bins[k], piece]
            else:
                space, k = self.capacity, len(self.bins)
                self.bins.append([piece])
                self.left.append(space)
            rest = self.left[k] = space - need
            by_space[rest].append(k)
            free |= 1 << rest
        return self

    def fill(self, pieces: list[int], rng: random.Random) -> "Packing":
        """Put the pieces into new bins, each the longest left with others that fill it well, and the rest by best fit."""
        left, rest = _longest_first(pieces, self.lengths), []
        while left:
            first = left.pop(0)
            some = range(len(left)) if len(left) <= CHOICE else sorted(rng.sample(range(len(left)), CHOICE))
            space = self.capacity - self.lengths[first]
            chosen = [some[k] for k in fullest([self.lengths[left[k]] for k in some], space)]
            made = [first, *(left[k] for k in chosen)]
            for k in reversed(chosen):
                del left[k]
            space = self.capacity - sum(map(self.lengths.__getitem__, made))
            if space <= _loose(self.capacity):
                self.bins.append(made)
                self.left.append(space)
            else:
                rest += made
        return self.insert(_longest_first(rest, self.lengths))

    @property
    def fitness(self) -> tuple[int, int]:
        """Fewer bins first, then more unequal filling, which leaves room to empty a bin."""
        return -len(self.bins), sum(map(mul, self.left, self.left))

    def places(self) -> list[int]:
        """The bin of every piece."""
        out = [0] * len(self.lengths)
        for k, members in enumerate(self.bins):
            for piece in members:
                out[piece] = k
        return out


def _from_places(lengths: list[int], capacity: int, places: list[int]) -> Packing:
    bins: list[list[int]] = [[] for _ in range(max(places, default=-1) + 1)]
    for piece, k in enumerate(places):
        bins[k].append(piece)
    return Packing(lengths, capacity, bins)


def _loose(capacity: int) -> float:
    """The space up to which a bin counts as well filled."""
    return (1 - WELL_FILLED) * capacity


def fullest(lengths: list[int], space: int) -> list[int]:
    """Positions, in order, of those lengths (longest first) that together leave the least of a space; long ones are preferred."""
    fits = (1 << space + 1) - 1
    sums = [1]  # bit r of sums[-1 - k]: some of the lengths from k on add up to r
    for length in reversed(lengths):
        sums.append(sums[-1] | sums[-1] << length & fits)
    wanted = sums[-1].bit_length() - 1
    found = []
    for k, length in enumerate(lengths):
        if length <= wanted and sums[-2 - k] >> wanted - length & 1:
            found.append(k)
            wanted -= length
    return found


def _longest_first(pieces: list[int], lengths: list[int]) -> list[int]:
    return sorted(pieces, key=lengths.__getitem__, reverse=True)


def cross(one: Packing, other: Packing, rng: random.Random) -> Packing:
    """A child of ``one`` with some well-filled bins of ``other`` in place of what they overlap."""
    limit = _loose(one.capacity)
    good = [k for k, space in enumerate(other.left) if space <= limit and rng.random() < INJECTED]
    taken = {piece for k in good for piece in other.bins[k]}
    bins, left, displaced = [other.bins[k] for k in good], [other.left[k] for k in good], []
    for b, space in zip(one.bins, one.left):
        # A bin goes for good if it shares a piece; most loose bins go as well, as mutation.
        if taken.isdisjoint(b) and (space <= limit or rng.random() < KEPT_LOOSE):
            bins.append(b)
            left.append(space)
        else:
            displaced += [piece for piece in b if piece not in taken]
    return Packing(one.lengths, one.capacity, bins, left).fill(displaced, rng)


def evolve(lengths: list[int], capacity: int, seeds: list[list[int]], seed: int) -> Packing:
    """The best packing after one epoch on one island; ``seeds`` are packings it starts from.

    The search ends at the lower bound, below which there is no packing, or when ``GENERATIONS`` of them
    have saved no bin.
    """
    rng = random.Random(seed)
    bound = -(-sum(lengths) // capacity)
    everything = range(len(lengths))
    people = [_from_places(lengths, capacity, s) for s in seeds]
    if not people:
        people = [Packing(lengths, capacity, []).insert(_longest_first(everything, lengths))]
    while len(people) < POPULATION and min(len(p.bins) for p in people) > bound:
        order = sorted(everything, key=lambda i: lengths[i] * (1 + NOISE * rng.random()), reverse=True)
        people.append(Packing(lengths, capacity, []).insert(order))
    people.sort(key=lambda p: p.fitness, reverse=True)
    fruitless = 0
    while len(people[0].bins) > bound and fruitless < GENERATIONS:
        fewest = len(people[0].bins)
        one, other = rng.sample(people, 2)
        people.append(cross(one, other, rng))
        people.sort(key=lambda p: p.fitness, reverse=True)
        people.pop()
        fruitless = 0 if len(people[0].bins) < fewest else fruitless + 1
    return people[0]


def _epoch(batches: Iterator[pa.RecordBatch], capacity: int, number: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            best = evolve(row["lengths"], capacity, row["seeds"], hash((row["shard"], row["island"], number)))
            bins, waste = best.fitness
            rows.append(row | {"seeds": [best.places()], "fitness": [bins, waste]})
        yield pa.RecordBatch.from_pylist(rows, schema=STATE)


STATE = pa.schema({"shard": pa.int64(), "island": pa.int32(), "lengths": pa.list_(pa.int32()), "seeds": pa.list_(pa.list_(pa.int32())), "fitness": pa.list_(pa.int64())})
STATE_DDL = "shard bigint, island int, lengths array<int>, seeds array<array<int>>, fitness array<bigint>"


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (a staged table with a column ``length`` of 1 to ``capacity``) with ``sequence_id``, ``offset``.

    Pieces of a sequence follow each other without a gap from offset 0. Which of several equal pieces
    goes where is arbitrary. No pieces give no rows.
    """
    n_shards = max(1, -(-pieces.count() // shard_pieces))
    item = F.struct(F.col("length").cast("int").alias("size"), F.monotonically_increasing_id().alias("nr"), F.struct(*(F.col(f"`{c}`") for c in pieces.columns)).alias("piece"))
    dealt = pieces.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_shards)).alias("shard"), item.alias("item"))
    shards = stage(dealt.groupBy("shard").agg(F.sort_array(F.collect_list("item"), False).alias("items")), "shards")
    none = F.array().cast("array<array<int>>")
    state = shards.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.col("items.size").alias("lengths"), none.alias("seeds"))
    together = Window.partitionBy("shard")
    ring = together.orderBy("island")
    total = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)
    for number in range(EPOCHS):
        dealt = state.repartition(min(n_shards * ISLANDS, 4096), "shard", "island")
        state = dealt.mapInArrow(partial(_epoch, capacity=capacity, number=number), STATE_DDL)
        best = F.col("seeds")[0]
        neighbour = F.coalesce(F.lead(best).over(ring), F.first(best).over(ring))
        # Where an island has reached the bound, the others have nothing left to look for.
        reached = -F.max(F.col("fitness")[0]).over(together) <= F.ceil(total / capacity)
        handed = F.when(reached, F.max_by(best, "fitness").over(together)).otherwise(neighbour)
        if number + 1 < EPOCHS:
            state = state.select("shard", "island", "lengths", F.array(best, handed).alias("seeds"))
    winners = state.groupBy("shard").agg(F.max_by(F.col("seeds")[0], "fitness").alias("bins"))
    placed = shards.join(winners, "shard").select("shard", F.explode(F.arrays_zip("items", "bins")).alias("x"))
    placed = placed.select("shard", F.col("x.bins").alias("bin"), F.col("x.items.nr").alias("nr"), F.col("x.items.piece").alias("piece"))
    earlier = Window.partitionBy("shard", "bin").orderBy("nr").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("piece.length").over(earlier), F.lit(0)).cast("bigint")
    return placed.select("piece.*", (F.shiftleft("shard", 32) + F.col("bin")).alias("sequence_id"), offset.alias("offset"))


def packed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``).

    A null or empty text is a document of its end id alone. Repeated rows are packed each on its own;
    a null doc_id stays null. Other columns are not read.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    cuts = map_ids(rows, TOKENIZER, f"pieces {PIECE}", cut)
    each = cuts.select("doc_id", F.posexplode("pieces").alias("piece", "p")).select("doc_id", "piece", "p.*")
    return pack(stage(each, "pieces"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packed_documents(table(spark, sf_dir, "documents"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the remaining documents as packed pieces."""
    return packed_documents(docs)
