"""Time the exact stratified split against a per-class row_number window.

Usage: python scripts/strata_vs_window.py [sf_dir] [copies]
Rows: the ratings fixture replicated ``copies`` times; class: rating >= 3
(two classes, one holding most rows).  Both take int(0.7 * n_class) rows
per class by (md5 hash, key).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from corvid.functions.hashing import hash_value  # noqa: E402
from corvid.operators import sampling  # noqa: E402
from corvid.sources import fixtures  # noqa: E402


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
    big = (
        r.select(F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_c"), *r.columns)
        .withColumn("row_id", F.monotonically_increasing_id())
        .withColumn("y", (F.col("rating") >= 3).cast("int"))
        .repartition(16)
        .persist()
    )
    n = big.count()
    t = time.time()
    ours = sampling.stratified_split(big, "row_id", "y", [0.7, 0.3], seed=1, exact=True)
    ours.write.format("noop").mode("overwrite").save()
    t_ours = time.time() - t
    t = time.time()
    h = big.withColumn("_h", hash_value("row_id", 1))
    w = Window.partitionBy("y").orderBy("_h", "row_id")
    cnt = Window.partitionBy("y")
    win = h.withColumn("rn", F.row_number().over(w)).withColumn("n_c", F.count(F.lit(1)).over(cnt))
    win = win.withColumn("split", F.when(F.col("rn") <= F.floor(0.7 * F.col("n_c")), "train").otherwise("test"))
    win.write.format("noop").mode("overwrite").save()
    t_win = time.time() - t
    a = {(x.y, x.split): x["count"] for x in ours.groupBy("y", "split").count().collect()}
    b = {(x.y, x.split): x["count"] for x in win.groupBy("y", "split").count().collect()}
    print(f"rows={n} exact_split={t_ours:.2f}s per_class_window={t_win:.2f}s same_counts={a == b} {a}")


if __name__ == "__main__":
    main()
