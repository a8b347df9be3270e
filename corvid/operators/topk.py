"""Top-k and arg-max with total tie-breaks.

``row_number() <= k`` over a window partitioned by the group is planned by
Spark as a partial ``WindowGroupLimit`` before the exchange, so at most k
rows per group and map partition cross the network and the final window
sorts only (partitions x k) rows per group, even when a group holds a
third of all keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(by: Sequence[str | Column], desc: Sequence[bool] | bool) -> list[Column]:
    if isinstance(desc, bool):
        desc = [desc] * len(by)
    out = []
    for c, d in zip(by, desc):
        col = F.col(c) if isinstance(c, str) else c
        out.append(col.desc_nulls_last() if d else col.asc_nulls_last())
    return out


def top_n(
    df: DataFrame,
    n: int,
    order_by: Sequence[str],
    descending: Sequence[bool] | bool,
    group_by: Sequence[str] = (),
    rank_col: str = "rank",
) -> DataFrame:
    """First ``n`` rows per group in the given total order, numbered 1..n.

    ``order_by`` must end in columns that make the order total (a tie-break),
    otherwise which tied row survives the cut is arbitrary.
    """
    order = _order(order_by, descending)
    if not group_by:
        # Global top-k: TakeOrderedAndProject keeps n rows per partition.
        w = Window.orderBy(*order)
        return df.orderBy(*order).limit(n).withColumn(rank_col, F.row_number().over(w))
    w = Window.partitionBy(*group_by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def arg_max(df: DataFrame, group_by: Sequence[str], value: str, key: str) -> DataFrame:
    """Per group, the key with the largest value (smallest key on ties).

    A top-1 window: the partial ``WindowGroupLimit`` keeps one row per group
    and map partition before the shuffle.
    """
    return top_n(df, 1, [value, key], [True, False], group_by).drop("rank")


def add_rest_bucket(
    counts: DataFrame,
    n: int,
    group: str,
    key: str,
    value: str,
    rest_label: str = "Rest",
) -> DataFrame:
    """Top-n keys per group plus one 'Rest' row holding the remainder.

    Adds ``rank`` (n+1 for Rest), ``pct`` (share of the group total, one
    decimal) and ``is_largest`` (the biggest slice of the group).
    """
    top = top_n(counts, n, [value, key], [True, False], [group])
    totals = counts.groupBy(group).agg(F.sum(value).alias("_total"))
    top_sum = top.groupBy(group).agg(F.sum(value).alias("_top"))
    rest = totals.join(top_sum, group).select(
        group,
        F.lit(n + 1).alias("rank"),
        F.lit(rest_label).alias(key),
        (F.col("_total") - F.col("_top")).alias(value),
    )
    both = top.select(group, "rank", key, value).unionByName(rest)
    w = Window.partitionBy(group)
    return (
        both.join(totals, group)
        .withColumn("pct", F.round(100.0 * F.col(value) / F.col("_total"), 1))
        .withColumn("is_largest", F.col(value) == F.max(value).over(w))
        .drop("_total")
    )
