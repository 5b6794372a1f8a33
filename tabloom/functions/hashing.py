"""Portable row hash: same value on any partitioning, in any engine that has MD5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 28


def hash28(*keys: Column | str, seed: int = 42, portable: bool = True) -> Column:
    """First 28 bits of MD5 over the key columns and the seed, joined by ``|``.

    ``portable=False`` takes the engine's own 64-bit hash: just as repeatable, many times cheaper,
    but only Spark can compute it.
    """
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    if not portable:
        return F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(HASH_RANGE))
    parts = [c.cast("string") for c in columns]
    digest = F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint")


def uniform(*keys: Column | str, seed: int = 42) -> Column:
    """A repeatable draw from [0, 1) per key."""
    return hash28(*keys, seed=seed) / F.lit(float(HASH_RANGE))
