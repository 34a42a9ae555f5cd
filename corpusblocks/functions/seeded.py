"""Seeded pseudo-random integers and uniforms that depend on key values only.

``rand`` depends on how rows are partitioned; a hash of the key gives the same
draw on any cluster, on any retry, and in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of hash kept in a sort key; the most that stays positive in a BIGINT.
KEY_BITS = 60


def _digest(seed: int, keys: tuple[Column, ...]) -> Column:
    parts = [F.lit(str(seed)), *[k.cast("string") for k in keys]]
    return F.md5(F.concat_ws(":", *parts))


def _hex_prefix(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def bucket(seed: int, *keys: Column, buckets: int) -> Column:
    """Integer in ``[0, buckets)`` from the first 32 bits of md5(seed:key:…)."""
    return _hex_prefix(_digest(seed, keys), 8) % F.lit(buckets)


def sort_key(seed: int, *keys: Column) -> Column:
    """Non-negative 60-bit integer to order rows by."""
    return _hex_prefix(_digest(seed, keys), KEY_BITS // 4)


def uniform(seed: int, *keys: Column) -> Column:
    """Double in ``[0, 1)`` with 52 random bits, exact in floating point."""
    return _hex_prefix(_digest(seed, keys), 13) / F.lit(float(2**52))
