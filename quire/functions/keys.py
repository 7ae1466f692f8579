"""Deterministic random keys.

Spark's ``rand()`` depends on partitioning, so every seeded choice (samples,
splits, folds, masks, draws) orders rows by ``md5(seed || '-' || id)``.  The
same expression exists in DuckDB, so the oracles reproduce the choice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(seed, *parts) -> Column:
    """md5 hex of ``seed-part1-part2...`` (all cast to string)."""
    cols = [F.lit(str(seed))]
    for p in parts:
        cols.append(F.lit("-"))
        cols.append((F.col(p) if isinstance(p, str) else p).cast("string"))
    return F.md5(F.concat(*cols))


def hash_bucket(key: Column, digits: int = 3) -> Column:
    """Leading hex digits of an md5 key as an int bucket (16**digits buckets)."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("int")


def unit_uniform(seed, *parts) -> Column:
    """Uniform double in [0, 1) from the first 13 hex digits of the md5 key."""
    return F.conv(F.substring(hash_key(seed, *parts), 1, 13), 16, 10).cast("double") / float(16 ** 13)
