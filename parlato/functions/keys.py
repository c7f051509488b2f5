"""Reproducible pseudo-random order from a seed and a key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIGITS = 32

# Four hexadecimal digits: hash order is cut into this many even ranges.
BUCKET_DIGITS = 4
BUCKETS = 16**BUCKET_DIGITS


def order_hash(seed: int, key: Column) -> Column:
    """Hexadecimal digits that depend on seed and key only, never on partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def hash_bucket(hashed: Column, digits: int = BUCKET_DIGITS) -> Column:
    return F.substring(hashed, 1, digits)
