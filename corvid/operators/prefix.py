"""Distributed running sums over a sorted key.

A window without ``partitionBy`` sorts everything in one task.  Here the
key range is cut at approximate quantiles into buckets (a bounded list of
boundaries, binary-searched per row by ``Bucketizer`` in the JVM); bucket
totals (one row per bucket) give each bucket's offset, and the running sum
inside a bucket is an ordinary partitioned window.  The result is exact;
the quantiles only balance the work.

Rows should be unique per key (aggregate first); a key repeated on a third
of the rows would otherwise land in one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_sums(
    df: DataFrame,
    order_col: str,
    value_cols: Sequence[str],
    buckets: int | None = None,
    rows_per_bucket: int = 200_000,
    suffix: str = "_before",
) -> DataFrame:
    """Adds ``<v>_before``: sum of ``v`` over rows with a smaller key.

    NULL keys come before all others and NaN after, in buckets of their own.
    ``buckets`` follows from the number of rows unless given; the quantiles'
    error is a quarter of their spacing.
    """
    if buckets is None:
        buckets = max(8, -(-df.count() // rows_per_bucket))
    probs = [i / buckets for i in range(1, buckets)]
    keyed = df.withColumn("_key_d", F.col(order_col).cast("double"))
    bounds = sorted(set(keyed.approxQuantile("_key_d", probs, 1 / (4 * buckets))))
    splits = [float("-inf"), *bounds, float("inf")]
    if len(splits) < 3:
        splits = [float("-inf"), float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="_key_d", outputCol="_bucket", handleInvalid="keep").transform(keyed)
    bucketed = bucketed.withColumn("_bucket", F.when(F.col("_key_d").isNull(), F.lit(-1.0)).otherwise(F.col("_bucket")))
    # One row per bucket: exclusive offsets from a window over the bucket table.
    per_bucket = bucketed.groupBy("_bucket").agg(*[F.sum(v).alias(f"_tot_{v}") for v in value_cols])
    ordered = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        "_bucket", *[F.coalesce(F.sum(f"_tot_{v}").over(ordered), F.lit(0)).alias(f"_off_{v}") for v in value_cols]
    )
    inside = Window.partitionBy("_bucket").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    joined = bucketed.join(F.broadcast(offsets), "_bucket")
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_off_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(f"{v}{suffix}")
            for v in value_cols
        ],
    )
