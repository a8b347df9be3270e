"""Column-level building blocks (all JVM-side, codegen-friendly)."""

from corvid.functions.hashing import hash_key, hash_value, salted
from corvid.functions.logfmt import (
    CLF_PATTERN,
    clf_columns,
    positional_columns,
    host_country,
)
from corvid.functions.timefmt import epoch_to_ts, ts_to_epoch, round6, clean_round

__all__ = [
    "hash_key",
    "hash_value",
    "salted",
    "CLF_PATTERN",
    "clf_columns",
    "positional_columns",
    "host_country",
    "epoch_to_ts",
    "ts_to_epoch",
    "round6",
    "clean_round",
]
