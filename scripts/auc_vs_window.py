"""Time exact AUC (bucketed running sums) against a single-partition window.

Usage: python scripts/auc_vs_window.py [sf_dir] [copies]
Scores are lineitem prices replicated ``copies`` times with a per-copy
offset, so nearly every score is distinct (the hard case for running sums).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from corvid.operators import metrics  # noqa: E402
from corvid.sources.readers import read_table  # noqa: E402


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
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    big = li.select(F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_c"), "*").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        (F.col("l_extendedprice") + F.col("_c") * F.lit(0.001)).alias("score"),
    )
    big = big.repartition(16).persist()
    n = big.count()
    t = time.time()
    a = metrics.auc_exact(big).first().auc
    t_ours = time.time() - t
    t = time.time()
    y = F.col("label") == 1.0
    s = big.groupBy("score").agg(F.sum(y.cast("long")).alias("pos"), F.sum((~y).cast("long")).alias("neg"))
    w = Window.orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    c = s.withColumn("nb", F.coalesce(F.sum("neg").over(w), F.lit(0)))
    b = c.agg((F.sum(F.col("pos") * (F.col("nb") + 0.5 * F.col("neg"))) / (F.sum("pos") * F.sum("neg"))).alias("auc")).first().auc
    t_win = time.time() - t
    print(f"rows={n} bucketed_running_sums={t_ours:.2f}s single_partition_window={t_win:.2f}s auc={a:.9f}/{b:.9f}")


if __name__ == "__main__":
    main()
