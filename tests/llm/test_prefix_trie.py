"""The trie of conversations against one built in memory from the contract's words."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from batchwarden.llm import prefix_trie as trie

DDL = "conv_id long, turn long, role string, text string"


def _digest(role: str, text: str) -> str:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def in_memory(rows: list[tuple]) -> list[tuple]:
    """All nodes, from lists of members per sequence of turns."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said = (role or "", text or "")
            turns[conv].append((turn is not None, turn or 0, _digest(*said), said))
    turns = {c: [x[3] for x in sorted(t, key=lambda x: x[:3])] for c, t in turns.items()}
    members, lengths, below = defaultdict(list), {}, defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built = tuple(turns.get(c - c % 20, [])[:h] + own[h:])
        lengths[c] = len(built)
        for d in range(len(built) + 1):
            members[built[:d]].append(c)
    for v in members:
        if v:
            below[v[:-1]].append(v)
    leaves, saved = {}, {}
    for v in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", v[-1][1])) if v else 0
        leaves[v] = sum(leaves[k] for k in below[v]) or 1
        saved[v] = (len(members[v]) - 1) * words + sum(saved[k] for k in below[v])
    found = []
    for v, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if lengths[c] == len(v))
        parent = min(members[v[:-1]]) if v else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(m), len(v), parent, len(m), len(below[v]), leaves[v], saved[v], sha))
    return sorted(found, key=str)


def _found(spark, rows: list[tuple]) -> list[tuple]:
    df = spark.createDataFrame(rows, DDL).repartition(5).withColumn("digest", F.lit("a clash"))
    return sorted((tuple(r) for r in trie.prefix_trie(df).collect()), key=str)


def _mixed() -> list[tuple]:
    draw = random.Random(1)
    rows = [(None, 0, "user", "belongs to no conversation")]
    for c in [*range(50), 100, 121, 400, 401]:
        for t in range(draw.choice([0, 1, 2, 3, 5, 9])):
            text = draw.choice(["x y", "a  b", "", None, "longer text here"])
            rows.append((c, draw.choice([t, t, None]), draw.choice(["u", "a", None]), text))
    return rows + rows[:20]


def test_shared_prefixes_nulls_and_repeats(spark):
    assert _found(spark, _mixed()) == in_memory(_mixed())


def test_segments_of_few_turns(spark, monkeypatch):
    monkeypatch.setattr(trie, "SEGMENT", 4)
    rows = [(c, t, "u", f"w{t % 3}") for c, n in ((5, 40), (25, 40), (6, 33)) for t in range(n)]
    rows += [(9, t, "u", f"only here {t}") for t in range(60)]
    assert _found(spark, rows) == in_memory(rows)
    assert _found(spark, _mixed()) == in_memory(_mixed())


def test_a_full_sketch_only_shuffles_more(spark, monkeypatch):
    monkeypatch.setattr(trie, "LEAST_WIDTH", 16)
    monkeypatch.setattr(trie, "MOST_WIDTH", 16)
    monkeypatch.setattr(trie, "SHARD", 16)
    assert _found(spark, _mixed()) == in_memory(_mixed())


def test_many_copies_of_one_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "HASHED", 40)
    rows = [(20 * c, t, "user", "hello there") for c in range(300) for t in range(3)]
    rows += [(3, 0, "user", "x" * 100_000)]
    assert _found(spark, rows) == in_memory(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")]])
def test_no_conversation_no_node(spark, rows):
    assert _found(spark, rows) == []
