"""Positions in a total order, without a task that sees all rows.

Rows are dealt by range of the order columns, sorted in their partitions and
checkpointed with an id that holds partition and place.  A position is the
number of rows in earlier partitions (a table of one row a partition) plus
the place.  Range bounds come from Spark's own bounded sample; they only
balance the work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.session import cut_lineage

_PLACE_BITS = 33  # fixed value: monotonically_increasing_id keeps the row in the lower 33 bits


def ordered(df: DataFrame, order: Sequence[Column | str], salt: bool = False, id_col: str = "_id", partitions: int | None = None) -> DataFrame:
    """``df`` in the given order, with an id that rises along it, cut off from lineage.

    ``salt`` adds a random last order column.  Rows that are equal in all
    order columns may then lie in several partitions, so no group of equal
    rows has to fit a task.
    """
    by = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    if salt:
        df, by = df.withColumn("_salt", F.rand(7)), [*by, F.col("_salt")]
    dealt = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    rows = dealt.sortWithinPartitions(*by).withColumn(id_col, F.monotonically_increasing_id())
    return cut_lineage(rows.drop("_salt"))


def partition_of(id_col: str = "_id") -> Column:
    return F.shiftright(id_col, _PLACE_BITS)


def ranked(df: DataFrame, order: Sequence[Column | str], rank_col: str = "rank", salt: bool = False) -> DataFrame:
    """``df`` plus ``rank_col``: 0, 1, 2 ... in the given order."""
    rows = ordered(df, order, salt).withColumn("_part", partition_of())
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_part", (F.coalesce(before, F.lit(0)) - F.shiftleft("_part", _PLACE_BITS)).alias("_offset"))
    # one row a partition
    joined = rows.join(F.broadcast(offsets), "_part")
    return joined.withColumn(rank_col, F.col("_id") + F.col("_offset")).drop("_part", "_offset", "_id")
