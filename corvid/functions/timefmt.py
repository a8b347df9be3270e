"""Time and number helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_to_ts(c: str | Column) -> Column:
    """Unix seconds -> TIMESTAMP_NTZ (wall clock in UTC, zone independent)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.timestamp_add("SECOND", col.cast("bigint"), F.expr(_EPOCH_NTZ))


def ts_to_epoch(c: str | Column) -> Column:
    """TIMESTAMP_NTZ -> Unix seconds, reading the wall clock as UTC."""
    col = F.col(c) if isinstance(c, str) else c
    return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), col.cast("timestamp_ntz"))


def clean_round(c: str | Column, digits: int) -> Column:
    """Round and fold -0.0 into 0.0 so hashes of equal values agree."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), digits) + F.lit(0.0)


def round6(c: str | Column) -> Column:
    return clean_round(c, 6)
