"""Engine-independent hashing: the same number in every run, partitioning and SQL engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_BITS = 60


def hash60(text: Column) -> Column:
    """First 15 hex digits of md5 as BIGINT in [0, 2^60)."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def seeded_hash60(key: Column, seed: int) -> Column:
    """Hash of a row key under a seed."""
    return hash60(F.concat(F.lit(f"{seed}:"), key.cast("string")))
