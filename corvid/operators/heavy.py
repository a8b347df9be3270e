"""Top keys per group by a frequency sketch, exact.

Counting every key of a group shuffles every key.  Here a first pass adds up
the weights in ``depth`` rows of ``width`` hash buckets a group (a mergeable
table: partial sums combine in any order).  A key's weight is at most that
of each of its buckets, so the least of them is its upper bound, and over
all keys of a group the bound exceeds the weight by total / width on
average, in each row.

The keys of the heaviest buckets are counted exactly.  The n-th largest of
these counts is a floor: a key under it is not in the top n, and neither is
one with a bucket under it.  A second count takes only the keys all of whose
buckets reach the floor, and its first n are the group's first n: whatever
was left out has an upper bound below n counts that are exact.  Ties at the
cut reach the floor too, so the tie-break sees them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.operators.topk import top_n
from corvid.session import cut_lineage

WIDTH, DEPTH = 1 << 16, 2
#: Buckets looked into for the floor, for each key asked for.
PROBES = 4


def _bucket(key: Column, row: int, width: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), key), F.lit(width)).cast("int")


def sketch(df: DataFrame, group_by: Sequence[str], key: str, weight: str | None = None, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """(group..., row, bucket, weight): sketches of parts of the rows add up by groupBy and sum."""
    own = F.col(weight) if weight else F.lit(1)
    places = F.explode(F.array(*(F.struct(F.lit(r).alias("row"), _bucket(F.col(key), r, width).alias("bucket")) for r in range(depth))))
    rows = df.where(F.col(key).isNotNull()).select(*group_by, own.cast("long").alias("weight"), places.alias("place"))
    return rows.groupBy(*group_by, "place.row", "place.bucket").agg(F.sum("weight").alias("weight"))


def merge(sketches: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """One sketch of several (unions of :func:`sketch` tables of one width and depth)."""
    return sketches.groupBy(*group_by, "row", "bucket").agg(F.sum("weight").alias("weight"))


def upper_bounds(keys: DataFrame, table: DataFrame, group_by: Sequence[str], key: str, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """(group..., key, bound) of distinct (group, key) rows: no key weighs more than its bound."""
    places = F.explode(F.array(*(F.struct(F.lit(r).alias("row"), _bucket(F.col(key), r, width).alias("bucket")) for r in range(depth))))
    at = keys.select(*group_by, key, places.alias("p")).select(*group_by, key, "p.row", "p.bucket")
    return at.join(table, [*group_by, "row", "bucket"]).groupBy(*group_by, key).agg(F.min("weight").alias("bound"))


def _counted(df: DataFrame, group_by: Sequence[str], key: str, weight: str | None, value: str) -> DataFrame:
    return df.groupBy(*group_by, key).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias(value))


def _in_buckets(df: DataFrame, buckets: DataFrame, group_by: Sequence[str], key: str, width: int, rows: Sequence[int]) -> DataFrame:
    """Rows whose key lies in one of ``buckets`` in each of the sketch's ``rows``."""
    for r in rows:
        own = buckets.where(F.col("row") == r).select(*group_by, F.col("bucket").alias("_bucket"))
        df = df.withColumn("_bucket", _bucket(F.col(key), r, width)).join(own, [*group_by, "_bucket"], "left_semi").drop("_bucket")
    return df


def heavy_hitters(
    df: DataFrame,
    n: int,
    group_by: Sequence[str],
    key: str,
    value: str = "count",
    weight: str | None = None,
    width: int = WIDTH,
    depth: int = DEPTH,
) -> DataFrame:
    """(group..., rank, key, value): the ``n`` keys of largest count (or sum of ``weight``) a group, by key on ties.

    Groups must not be NULL; NULL keys are not counted.  ``df`` is read three
    times, each time only its group, key and weight.
    """
    df = df.select(*group_by, key, *([weight] if weight else [])).where(F.col(key).isNotNull())
    table = cut_lineage(sketch(df, group_by, key, weight, width, depth))
    first = top_n(table.where("row = 0"), PROBES * n, ["weight", "bucket"], [True, False], group_by).select(*group_by, "row", "bucket")
    probed = _counted(_in_buckets(df, first, group_by, key, width, [0]), group_by, key, weight, value)
    best = top_n(probed, n, [value, key], [True, False], group_by)
    # fewer than n keys in these buckets: no floor
    floors = cut_lineage(best.groupBy(*group_by).agg(F.when(F.count(F.lit(1)) == n, F.min(value)).otherwise(F.lit(0)).alias("floor")))
    may = cut_lineage(table.join(floors, list(group_by)).where("weight >= floor").select(*group_by, "row", "bucket"))
    counted = _counted(_in_buckets(df, may, group_by, key, width, range(depth)), group_by, key, weight, value)
    return top_n(counted, n, [value, key], [True, False], group_by).select(*group_by, "rank", key, value)
