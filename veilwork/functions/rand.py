"""Keyed draws: equal seed and keys give equal numbers on any cluster, whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mix(seed: int, *keys: Column | str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]))


def uniform(seed: int, *keys: Column | str) -> Column:
    """In [0, 1), from the first 32 bits of the hash."""
    return F.conv(F.substring(mix(seed, *keys), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def between(low: float, high: float, seed: int, *keys: Column | str) -> Column:
    return F.lit(float(low)) + uniform(seed, *keys) * F.lit(float(high - low))


def shuffle_key(seed: int, *keys: Column | str) -> Column:
    """Sort by this and then by the keys for a seeded full shuffle."""
    return mix(seed, *keys)
