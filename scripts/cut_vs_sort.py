"""Time the exact histogram cut against a global row_number window.

Usage: python scripts/cut_vs_sort.py [sf_dir] [copies]
The ratings fixture is replicated ``copies`` times (each copy shifted in
time, so the order stays total) to see how both approaches grow.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from corvid.operators import sampling  # noqa: E402
from corvid.sources import fixtures  # noqa: E402

ORDER = ["timestamp", "userId", "movieId", "rating"]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    r = fixtures.ratings(spark, sf_dir)
    big = r.select(
        F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_c"), *r.columns
    ).select((F.col("timestamp") + F.col("_c").cast("long") * F.lit(10**9)).alias("timestamp"), "userId", "movieId", "rating")
    big = big.repartition(16).persist()
    n = big.count()
    f = 0.4
    t = time.time()
    exact = sampling.chrono_split(big, ORDER, [f])
    exact.write.format("noop").mode("overwrite").save()
    t_cut = time.time() - t
    t = time.time()
    w = Window.orderBy(*ORDER)
    ranked = big.withColumn("rn", F.row_number().over(w)).withColumn("train_40", F.col("rn") <= int(f * n))
    ranked.write.format("noop").mode("overwrite").save()
    t_win = time.time() - t
    a = exact.filter("train_40").count()
    b = ranked.filter("train_40").count()
    print(f"rows={n} histogram_cut={t_cut:.2f}s global_window={t_win:.2f}s head={a}/{b}")


if __name__ == "__main__":
    main()
