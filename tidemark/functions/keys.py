"""Deterministic pseudo-random keys.

Sampling orders rows by an MD5 key instead of ``rand()``: the key depends only
on the row and the seed, so a recomputed task or another partitioning selects
exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import col


def row_key(seed: int | str, *cols: Column | str) -> Column:
    """Hex MD5 of ``seed:value[|value...]``."""
    parts = [col(c).cast("string") for c in cols]
    body = parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)
    return F.md5(F.concat(F.lit(f"{seed}:"), body))


def hash_fraction(seed: int | str, *cols: Column | str) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of the row key."""
    head = F.conv(F.substring(row_key(seed, *cols), 1, 8), 16, 10)
    return head.cast("double") / F.lit(4294967296.0)


def value_fraction(c: Column) -> Column:
    """Cheap uniform number in [0, 1) that depends only on the value."""
    return F.pmod(F.xxhash64(c), F.lit(1 << 40)) / F.lit(float(1 << 40))
