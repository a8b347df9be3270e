"""Stable hash buckets.

A row's bucket depends only on its key, never on partitioning or task
order, so splits and samples are reproducible after a retry, disjoint by
construction and checkable in plain SQL:
``CAST(('0x' || substr(md5('seed|k1|k2'), 1, 8)) AS BIGINT)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 32 bits of the md5 digest: 0 .. 2**32 - 1.
MD5_SPACE = 1 << 32


def _cols(key_cols) -> list[Column]:
    if isinstance(key_cols, (str, Column)):
        key_cols = [key_cols]
    return [F.col(c) if isinstance(c, str) else c for c in key_cols]


def hash_key(key_cols, seed: int | str | None = None) -> Column:
    """The string that is hashed: 'seed|k1|k2...' (or just the key; a NULL key is an empty one)."""
    parts = [c.cast("string") for c in _cols(key_cols)]
    if seed is not None:
        parts = [F.lit(str(seed))] + parts
    else:
        parts = [F.coalesce(p, F.lit("")) for p in parts]
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def salted(seed: int | None, operation: str) -> str:
    """A seed of its own for each kind of draw, so that a sample of a split is independent of the split."""
    return f"{'' if seed is None else seed}{operation}"


def hash_value(key_cols, seed: int | str | None = None) -> Column:
    """First 32 bits of md5(seed|key) as a bigint in [0, 2**32)."""
    return F.conv(F.substring(F.md5(hash_key(key_cols, seed)), 1, 8), 16, 10).cast("bigint")
