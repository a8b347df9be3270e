"""Category dictionaries of any size, kept as tables.

MLlib's ``StringIndexer`` holds every label on the driver and in each task.
Here a dictionary is a table (label, n, index) on the executors: labels are
counted by partial and final aggregates, and their index is the position in
the order asked for, found by range (``ranks.ranked``).  Indexing joins the
dictionary back.  Labels that hold a large share of the rows are few by
arithmetic (at most ``HOT`` of them have a share of 1/HOT), so these go out
by broadcast and their rows are spread; all others join by exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators.ranks import ranked
from corvid.session import cut_lineage

#: A label with 1/HOT of the rows or more is hot: at most HOT labels.
HOT = 1000
#: Parts that the rows of hot labels are spread over in the exchange.
SPREAD = 1024

_ORDERS = {
    "frequencyDesc": lambda: [F.col("n").desc(), F.col("label")],
    "frequencyAsc": lambda: [F.col("n").asc(), F.col("label")],
    "alphabetDesc": lambda: [F.col("label").desc()],
    "alphabetAsc": lambda: [F.col("label").asc()],
}


def fit(df: DataFrame, col: str, order: str = "frequencyDesc") -> DataFrame:
    """(label, n, index) of a column's values as text; equal frequencies go by the label's bytes.

    NULL is no label.  The table is checkpointed, so it can be joined often.
    """
    if order not in _ORDERS:
        raise ValueError(f"order must be one of {sorted(_ORDERS)}")
    counts = df.select(F.col(col).cast("string").alias("label")).where("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return cut_lineage(ranked(counts, _ORDERS[order](), "index"))


def apply(df: DataFrame, dictionary: DataFrame, col: str, out_col: str | None = None, handle_invalid: str = "error") -> DataFrame:
    """``df`` plus the index of ``col`` as a long.

    A value that is not in the dictionary, or NULL, fails the query
    (``error``), gets the index after the last (``keep``) or drops its row
    (``skip``).
    """
    if handle_invalid not in ("error", "keep", "skip"):
        raise ValueError("handle_invalid must be 'error', 'keep' or 'skip'")
    out_col = out_col or f"{col}_index"
    size = dictionary.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("labels")).first()
    labels = size["labels"]
    hot = dictionary.where(F.col("n") * HOT >= F.lit(size["rows"] or 0)).select(F.col("label").alias("_hot"), F.col("index").alias("_hot_index"))
    cold = dictionary.select(F.col("label").alias("_label"), F.col("index").alias("_index"), F.lit(0).alias("_to"))
    named = df.withColumn("_text", F.col(col).cast("string")).join(F.broadcast(hot), F.col("_text") == F.col("_hot"), "left")
    # rows of hot labels (and NULLs) match nothing below: they only pass through the exchange, spread out
    found = F.col("_hot").isNotNull() | F.col("_text").isNull()
    named = named.withColumn("_key", F.when(~found, F.col("_text"))).withColumn("_from", F.when(found, 1 + F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD))).otherwise(0).cast("int"))
    got = named.join(cold, (F.col("_key") == F.col("_label")) & (F.col("_from") == F.col("_to")), "left")
    index = F.coalesce("_hot_index", "_index")
    if handle_invalid == "keep":
        index = F.coalesce(index, F.lit(labels))
    elif handle_invalid == "error":
        index = F.coalesce(index, F.raise_error(F.concat(F.lit(f"value of {col} is not in the dictionary: "), F.coalesce("_text", F.lit("NULL")))).cast("long"))
    out = got.select(*df.columns, index.cast("long").alias(out_col))
    return out.where(F.col(out_col).isNotNull()) if handle_invalid == "skip" else out


def fit_apply(df: DataFrame, cols: list[str], handle_invalid: str = "error", order: str = "frequencyDesc") -> DataFrame:
    """``df`` with ``<c>_index`` of each column, by dictionaries of its own values."""
    out = df
    for c in cols:
        out = apply(out, fit(df, c, order), c, handle_invalid=handle_invalid)
    return out
