"""A prefix trie of conversations, with the prefixes that may be shared told apart by a count-min sketch.

A prefix of d turns is known by a 127-bit polynomial hash of its turns' digests. Such hashes compose, so
a conversation is cut into segments of bounded length that are hashed apart from each other; only one
short record per segment meets the others of its conversation. Every prefix is counted in a count-min
sketch. A prefix that meets a counter of one is certainly in one conversation alone, and so are all
longer ones: these tails become nodes where they are. The rest is shuffled and grouped exactly.

The smallest member of a node is also the smallest member of every node below it on its own path, so
each conversation owns the nodes of its path below some depth p. That turns all sums over a subtree
into sums over the members of the node, and no walk over levels is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from batchwarden.llm.common import WORD, attach, stage, table

GROUP = 20  # conversations that begin like the first of their twenty
HEADS = 4  # a conversation takes 0 .. HEADS - 1 turns from that one
SEGMENT = 4096  # turns of one conversation that are kept in one record
FIELD = (1 << 127) - 1
POINT = 0x5D2A1C3B9F4E60718293A4B5C6D7E8F9 % FIELD
# Counters per row of the sketch: four for every prefix, within these bounds. What is sent to the
# executors is one bit per counter, 32 MiB at most. With more prefixes than that has room for, fewer
# are proven alone and more are shuffled; the result is the same.
ROWS = 2
LEAST_WIDTH, MOST_WIDTH = 1 << 16, 1 << 27
SHARD = 1 << 16
PARTIAL = 1 << 21  # prefixes counted before a task hands on its counters
HASHED = 1 << 18  # bytes of an id list in one record

SEGMENTS = "conv_id bigint, seq bigint, n int, total binary, words_total bigint, digests binary, words binary"
CHAIN = "seq bigint, skip int, final boolean, opening boolean, depth bigint, state binary, before bigint, head binary, head_words binary"
PLACED = "conv_id bigint, opening boolean, final boolean, depth bigint, before bigint, n int, prefixes binary, words binary"
SCREENED = (
    "conv_id bigint, opening boolean, turnless boolean, final boolean, tail_from bigint, tail_to bigint, "
    "shared array<struct<depth:bigint,digest:binary,words:bigint,before:bigint,is_end:boolean,tailed:boolean>>"
)
NODES = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def _turns(conversations: DataFrame) -> DataFrame:
    """Digest and number of words per turn; equal turns of one place in one record with their count."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.md5(whole)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    counts = turns.filter("conv_id IS NOT NULL").groupBy("conv_id", "turn", "digest", "words")
    return counts.agg(F.count(F.lit(1)).alias("copies"))


def _number(data: bytes) -> int:
    return int.from_bytes(data, "big")


def _bytes(value: int) -> bytes:
    return value.to_bytes(16, "big")


def _extend(state: int, digest: bytes) -> int:
    """The hash of a prefix with one more turn."""
    return (state * POINT + _number(digest)) % FIELD


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def _segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns to segments; ``seq`` orders them, as the tasks hold consecutive ranges of turns."""
    schema, made = _arrow(SEGMENTS), 0
    first = TaskContext.get().partitionId() << 32
    conversation, digests, words = None, [], []

    def record() -> tuple:
        state = 0
        for d in digests:
            state = _extend(state, d)
        packed = np.array(words, "<i8").tobytes()
        return conversation, first + made, len(digests), _bytes(state), sum(words), b"".join(digests), packed

    for batch in batches:
        rows = []
        for conv, digest, count, copies in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "digest", "words", "copies"))):
            for _ in range(copies):
                if digests and (conv != conversation or len(digests) == SEGMENT):
                    rows.append(record())
                    made += 1
                    digests, words = [], []
                    if len(rows) == 500:
                        yield _table(rows, schema)
                        rows = []
                conversation = conv
                digests.append(digest)
                words.append(count)
        yield _table(rows, schema)
    if digests:
        yield _table([record()], schema)


def _segments(turns: DataFrame) -> DataFrame:
    """Segments of all conversations. Turns that share a number are ordered by their digests."""
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("digest").asc()]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(_segment, SEGMENTS)


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each segment stands in its rebuilt conversation.

    The records of a group of conversations come together, the one they begin like first, each in the
    order of its segments. Segments of which no turn is kept are passed over, unless there is no other.
    """
    schema = _arrow(CHAIN)
    base, head, head_words = None, [], []
    conversation, pending = None, None
    start = words_before = 0
    state = own = own_words = 0  # hash and words of all own turns so far, and of the first h of them
    opened = False

    def finish(final: bool) -> list[tuple]:
        return [] if pending is None else [(*pending[:2], final, *pending[2:])]

    for batch in batches:
        rows: list[tuple] = []
        for r in batch.to_pylist():
            if r["conv_id"] != conversation:
                rows += finish(True)
                pending = None
                if r["base"] != base:
                    base, head, head_words = r["base"], [], []
                conversation, start, state, words_before, own, own_words, opened = r["conv_id"], 0, 0, 0, 0, 0, False
            h, n = r["h"], r["n"]
            first_words = np.frombuffer(r["first_words"], "<i8").tolist()
            firsts = [r["firsts"][16 * i : 16 * i + 16] for i in range(len(first_words))]
            for i, (d, w) in enumerate(zip(firsts, first_words)):
                if start + i < HEADS - 1 and conversation == base:
                    head.append(d)
                    head_words.append(w)
                if start + i < h:
                    own, own_words = _extend(own, d), own_words + w
            begun = 0
            for d in head[:h]:
                begun = _extend(begun, d)
            k = min(h, len(head))
            skip = min(max(h - start, 0), n)
            kept = max(start, h) - h
            # Own turns after the first h, put after the head: the first h are taken out of the hash.
            here = (state + (begun - own) * pow(POINT, kept, FIELD)) % FIELD if start >= h else begun
            words_here = sum(head_words[:k]) + (words_before - own_words if start >= h else 0)
            if start + n > h:
                if opened:
                    rows += finish(False)
                shown = (b"".join(head[:k]), np.array(head_words[:k], "<i8").tobytes()) if not opened else (b"", b"")
                pending = (r["seq"], skip, not opened, k + kept, _bytes(here), words_here, *shown)
                opened = True
            elif not opened:
                pending = (r["seq"], n, True, k, _bytes(here), words_here, b"".join(head[:k]), np.array(head_words[:k], "<i8").tobytes())
            state = (state * pow(POINT, n, FIELD) + _number(r["total"])) % FIELD
            start, words_before = start + n, words_before + r["words_total"]
        yield _table(rows, schema)
    yield _table(finish(True), schema)


def _chain(segments: DataFrame) -> DataFrame:
    """One short record per segment, met by the others of its group of conversations."""
    text = F.col("conv_id").cast("string")
    base = (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base")
    short = segments.select(
        base,
        "conv_id",
        "seq",
        "n",
        "total",
        "words_total",
        (F.crc32(text) % HEADS).cast("int").alias("h"),
        F.substring("digests", 1, 16 * (HEADS - 1)).alias("firsts"),
        F.substring("words", 1, 8 * (HEADS - 1)).alias("first_words"),
    )
    order = ["base", (F.col("conv_id") != F.col("base")), "conv_id", "seq"]
    return short.repartition("base").sortWithinPartitions(*order).mapInArrow(_link, CHAIN)


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with the hash of every prefix that ends in them."""
    schema = _arrow(PLACED)
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            k = len(r["head_words"]) // 8
            state, depth, before, prefixes = _number(r["state"]), r["depth"], r["before"], []
            words = np.frombuffer(r["words"], "<i8")[r["skip"] :]
            if k:
                begun = 0
                for i in range(k):
                    begun = _extend(begun, r["head"][16 * i : 16 * i + 16])
                    prefixes.append(_bytes(begun))
                head_words = np.frombuffer(r["head_words"], "<i8")
                words, depth, before = np.concatenate([head_words, words]), depth - k, before - int(head_words.sum())
            for i in range(r["skip"], r["n"]):
                state = _extend(state, r["digests"][16 * i : 16 * i + 16])
                prefixes.append(_bytes(state))
            rows.append((r["conv_id"], r["opening"], r["final"], depth, before, len(prefixes), b"".join(prefixes), words.tobytes()))
        yield _table(rows, schema)


def _places(prefixes: bytes, width: int) -> np.ndarray:
    """The counters of prefixes, one line per row of the sketch."""
    pairs = np.frombuffer(prefixes, ">u8").reshape(-1, 2).astype(np.uint64)
    lines = [(pairs[:, r % 2] & np.uint64(width - 1)) + np.uint64(r * width) for r in range(ROWS)]
    return np.stack(lines).astype(np.int64)


def _count(width: int):
    """Counters met by the prefixes of a task, by shards, as places and counts that stop at 255."""
    schema = pa.schema([("shard", pa.int32()), ("places", pa.binary()), ("counts", pa.binary())])

    def partial(places: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate(places), return_counts=True)
        counts = np.minimum(counts, 255).astype(np.uint8)
        cuts = np.flatnonzero(np.diff(found // SHARD)) + 1
        parts = zip(np.split(found, cuts), np.split(counts, cuts))
        return _table([(int(p[0] // SHARD), (p % SHARD).astype("<u2").tobytes(), c.tobytes()) for p, c in parts if len(p)], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for prefixes in batch.column("prefixes").to_pylist():
                held.append(_places(prefixes, width).ravel())
                n += len(held[-1])
                if n >= ROWS * PARTIAL:
                    yield partial(held)
                    held, n = [], 0
        if n:
            yield partial(held)

    return run


def _ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per shard one bit per counter: whether the summed count is one. Equal shards come together."""
    schema = pa.schema([("shard", pa.int32()), ("ones", pa.binary())])
    shard, sums = None, None
    for batch in batches:
        done = []
        for r in batch.to_pylist():
            if r["shard"] != shard:
                if shard is not None:
                    done.append((shard, np.packbits(sums == 1).tobytes()))
                shard, sums = r["shard"], np.zeros(SHARD, np.uint8)
            places, counts = np.frombuffer(r["places"], "<u2"), np.frombuffer(r["counts"], np.uint8)
            sums[places] = np.minimum(sums[places].astype(np.int64) + counts, 255)
        yield _table(done, schema)
    if shard is not None:
        yield _table([(shard, np.packbits(sums == 1).tobytes())], schema)


def sketch(placed: DataFrame, width: int) -> bytes:
    """The count-min sketch of all prefixes, as one bit per counter: whether it is one."""
    partial = placed.select("prefixes").mapInArrow(_count(width), "shard int, places binary, counts binary")
    merged = partial.repartition("shard").sortWithinPartitions("shard").mapInArrow(_ones, "shard int, ones binary")
    bits = bytearray(ROWS * width // 8)
    for r in merged.toLocalIterator():  # ROWS * width / SHARD records, bounded by MOST_WIDTH
        bits[r["shard"] * SHARD // 8 : (r["shard"] + 1) * SHARD // 8] = r["ones"]
    return bytes(bits)


def _screen(bits, width: int):
    """Splits each segment into the prefixes that may be shared, with the first that is not, and a tail."""
    item = pa.struct(
        [("depth", pa.int64()), ("digest", pa.binary()), ("words", pa.int64()), ("before", pa.int64()), ("is_end", pa.bool_()), ("tailed", pa.bool_())]
    )
    flags = [(c, pa.bool_()) for c in ("opening", "turnless", "final")]
    schema = pa.schema([("conv_id", pa.int64()), *flags, ("tail_from", pa.int64()), ("tail_to", pa.int64()), ("shared", pa.list_(item))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketched = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                n, depth = r["n"], r["depth"]
                places = _places(r["prefixes"], width)
                alone = ((sketched[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1).any(axis=0)
                sent = int(alone.argmax()) + 1 if alone.any() else n
                words = np.frombuffer(r["words"], "<i8")
                before = r["before"] + np.concatenate([[0], np.cumsum(words)[:-1]]) if n else words
                shared = [
                    (depth + 1 + i, r["prefixes"][16 * i : 16 * i + 16], int(words[i]), int(before[i]), r["final"] and i == n - 1, sent < n)
                    for i in range(sent)
                ]
                keys = [f.name for f in item]
                entries = [dict(zip(keys, s)) for s in shared]
                tail = (depth + sent + 1, depth + n) if sent < n else (None, None)
                rows.append((r["conv_id"], r["opening"], r["opening"] and n == 0, r["final"], *tail, entries))
            yield _table(rows, schema)

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (digest, conv_id) to stretches of comma-joined ids of one digest."""
    schema = pa.schema([("digest", pa.binary()), ("first", pa.int64()), ("ids", pa.binary())])
    digest, first, ids, size = None, None, [], 0
    for batch in batches:
        rows = []
        for d, c in zip(batch.column("digest").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (d != digest or size >= HASHED):
                rows.append((digest, first, ",".join(ids).encode()))
                ids, size = [], 0
            if not ids:
                digest, first = d, c
            ids.append(str(c))
            size += len(ids[-1]) + 1
        yield _table(rows, schema)
    if ids:
        yield _table([(digest, first, ",".join(ids).encode())], schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted stretches to one SHA-256 per digest, with one stretch in memory at a time."""
    schema = pa.schema([("digest", pa.binary()), ("ends_sha256", pa.string())])
    digest, running = None, None
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if running is not None and r["digest"] == digest:
                running.update(b",")
            else:
                if running is not None:
                    rows.append((digest, running.hexdigest()))
                digest, running = r["digest"], hashlib.sha256()
            running.update(r["ids"])
        yield _table(rows, schema)
    if running is not None:
        yield _table([(digest, running.hexdigest())], schema)


def _ends(members: DataFrame) -> DataFrame:
    """The digest of the sorted ids that end at each node, from (digest, conv_id).

    A list of any length is cut into stretches over the tasks; the last step only reads these bytes.
    """
    ranged = members.repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    stretches = ranged.mapInArrow(_listed, "digest binary, first bigint, ids binary")
    together = stretches.repartition("digest").sortWithinPartitions("digest", "first")
    return together.mapInArrow(_hashed, "digest binary, ends_sha256 string")


def _sha(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie over rebuilt conversations: see ``NODES``.

    Turns are ordered by number, null first, turns of one number by their digest; a turn given twice
    counts twice. A null role or text is empty. Rows without conv_id belong to no conversation. Other
    columns are ignored. Without any conversation there is no node, not even a root. The group of a
    negative conv_id follows SQL's remainder.
    """
    spark = conversations.sparkSession
    segments = stage(_segments(stage(_turns(conversations), "turns")), "segments")
    chain = _chain(segments)
    placed = stage(segments.join(chain, "seq").mapInArrow(_place, PLACED), "placed")

    n_prefixes = placed.agg(F.sum("n")).first()[0] or 0
    width = LEAST_WIDTH
    while width < 4 * n_prefixes and width < MOST_WIDTH:
        width *= 2
    bits = spark.sparkContext.broadcast(sketch(placed, width))
    screened = stage(placed.mapInArrow(_screen(bits, width), SCREENED), "screened")

    rows = screened.select("conv_id", F.inline("shared"))
    nodes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("owner"), F.count_if("is_end").alias("n_ends"))
    shared = stage(nodes.filter("n > 1"), "shared")
    known = attach(rows, shared, "digest", "n").withColumns(
        {
            "owner": F.coalesce("owner", "conv_id"),
            "n": F.coalesce("n", F.lit(1)),
            "n_ends": F.coalesce("n_ends", F.col("is_end").cast("bigint")),
        }
    )
    known = stage(known, "known")

    totals = screened.agg(F.count_if("opening").alias("n"), F.min("conv_id").alias("smallest")).first()
    mine = F.col("owner") == F.col("conv_id")
    last_shared = F.max(F.when(~mine, F.struct("depth", "owner", (F.col("before") + F.col("words")).alias("words"))))
    leaf = F.max((F.col("tailed") | (F.col("is_end") & mine & (F.col("n_ends") == F.col("n")))).cast("bigint"))
    facts = known.groupBy("conv_id").agg(last_shared.alias("s"), leaf.alias("leaf"), F.count(F.lit(1)).alias("n_rows"))
    facts = facts.select(
        "conv_id",
        "n_rows",
        "leaf",
        F.coalesce("s.depth", F.lit(0)).alias("p"),
        F.coalesce("s.owner", F.lit(totals["smallest"])).alias("above"),
        F.coalesce("s.words", F.lit(0)).alias("shared_words"),
    )
    facts = stage(facts, "owners")

    members = attach(known.select("conv_id", "depth", "digest", "before", "is_end", "owner"), facts, "conv_id", "n_rows")
    depth, p = F.col("depth"), F.col("p")
    parent = F.when(depth - 1 > p, F.col("conv_id")).otherwise(F.col("above"))
    exact = members.groupBy("digest").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max(F.when(F.col("owner") == F.col("conv_id"), parent)).alias("parent_conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.count_if((depth >= p) & ~F.col("is_end")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.when(depth <= p, F.col("shared_words") - F.col("before")).otherwise(0)).alias("saved_tokens"),
        F.count_if("is_end").alias("n_ends"),
    )
    several = known.filter("is_end AND n > 1").select("digest", "conv_id")
    exact = exact.join(_ends(several), "digest", "left")
    one = F.when(F.col("n_ends") == 1, _sha(F.col("conv_id").cast("string"))).otherwise(_sha(F.lit("")))
    exact = exact.withColumn("ends_sha256", F.when(F.col("n_convs") > 1, F.coalesce("ends_sha256", _sha(F.lit("")))).otherwise(one))

    at_end = F.col("final") & (F.col("depth") == F.col("tail_to"))
    tails = screened.filter("tail_to IS NOT NULL").withColumn("depth", F.explode(F.sequence("tail_from", "tail_to"))).select(
        "conv_id",
        "depth",
        F.col("conv_id").alias("parent_conv_id"),
        F.lit(1).alias("n_convs"),
        F.when(at_end, 0).otherwise(1).alias("n_children"),
        F.lit(1).alias("n_leaves"),
        F.lit(0).alias("saved_tokens"),
        F.when(at_end, _sha(F.col("conv_id").cast("string"))).otherwise(_sha(F.lit(""))).alias("ends_sha256"),
    )

    turnless = screened.filter("turnless").select(F.lit(b"").alias("digest"), "conv_id")
    sums = facts.agg(
        F.count_if(F.col("p") == 0).alias("n_children"),
        F.greatest(F.coalesce(F.sum("leaf"), F.lit(0)), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("shared_words"), F.lit(0)).alias("saved_tokens"),
    )
    root = sums.withColumn("digest", F.lit(b"")).join(_ends(turnless), "digest", "left").select(
        F.lit(totals["smallest"]).alias("conv_id"),
        F.lit(0).alias("depth"),
        F.lit(None).alias("parent_conv_id"),
        F.lit(totals["n"]).alias("n_convs"),
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", _sha(F.lit(""))).alias("ends_sha256"),
    )
    if not totals["n"]:
        return spark.createDataFrame([], NODES)
    names = [field.split()[0] for field in NODES.split(", ")]
    parts = [part.select(*[F.col(c).cast("string" if c == "ends_sha256" else "bigint").alias(c) for c in names]) for part in (exact, tails, root)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))
