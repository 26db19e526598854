"""Reproducible pseudo-random choices that depend on a row's content, never on its position."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash32(seed: int | str, key: Column) -> Column:
    """An even 32-bit number per key: the head of an MD5 digest, the same in every engine."""
    text = F.concat(F.lit(f"{seed}|"), key)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def bucket(seed: int | str, key: Column, size: int) -> Column:
    """Bucket 0 .. size-1 of a key."""
    return hash32(seed, key) % F.lit(size)


def fraction(seed: int | str, key: Column) -> Column:
    """An even number in [0, 1) per key."""
    return hash32(seed, key).cast("double") / F.lit(4294967296.0)
