"""Run the composite jobs end to end and write every report table.

    python scripts/run_jobs.py --out DIR [--jobs logs,claims,classify,recommend]
        [--sf-dir /root/testdata/sf0.01]            # fixtures derived from the tables
        [--log PATH] [--claims-csv PATH] [--particles-csv PATH]
        [--ratings-csv PATH --movies-csv PATH]     # or the jobs' own input files

Each report is written as Parquet under DIR/<job>/<report>.  The session
is built here (the library never builds one); on a cluster submit this
script with spark-submit and the cluster's own settings.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from corvid.operators import models  # noqa: E402
from corvid.plans import jobs  # noqa: E402
from corvid.sources import fixtures, readers  # noqa: E402
from corvid.sources.sinks import write_report  # noqa: E402

SEED = 4711

CLAIMS_SCHEMA = T.StructType(
    [
        T.StructField("IDpol", T.DoubleType()),
        T.StructField("ClaimNb", T.LongType()),
        T.StructField("Exposure", T.DoubleType()),
        T.StructField("Area", T.StringType()),
        T.StructField("VehPower", T.LongType()),
        T.StructField("VehAge", T.LongType()),
        T.StructField("DrivAge", T.LongType()),
        T.StructField("BonusMalus", T.LongType()),
        T.StructField("VehBrand", T.StringType()),
        T.StructField("VehGas", T.StringType()),
        T.StructField("Density", T.LongType()),
        T.StructField("Region", T.StringType()),
    ]
)


def run_logs(spark, args):
    if args.log:
        lines = readers.read_text_lines(spark, args.log, min_partitions=spark.sparkContext.defaultParallelism)
    else:
        lines = fixtures.access_log_lines(spark, args.sf_dir)
    return jobs.log_report(lines, n=9)


def run_claims(spark, args):
    if args.claims_csv:
        df = readers.read_csv(spark, args.claims_csv, CLAIMS_SCHEMA, header=True)
        df = df.withColumn("hasClaim", (F.col("ClaimNb") > 0).cast("int"))
        return jobs.claims_models(
            df, "IDpol", ["Exposure", "VehPower", "VehAge", "DrivAge", "BonusMalus", "Density"],
            ["VehBrand", "VehGas", "Region", "Area"], seed=SEED,
        )
    df = fixtures.claims(spark, args.sf_dir)
    return jobs.claims_models(
        df, "o_orderkey", ["Exposure", "o_totalprice", "c_acctbal"],
        ["o_orderpriority", "o_orderstatus", "c_mktsegment"], seed=SEED,
    )


def run_classify(spark, args):
    if args.particles_csv:
        df = readers.read_csv(spark, args.particles_csv, readers.PARTICLES_SCHEMA, header=False)
        df = df.withColumn("row_key", F.xxhash64(*df.columns))
        key, feats, frac = ["row_key"], readers.PARTICLE_FEATURES, 0.01
    else:
        df = fixtures.particles_separable(spark, args.sf_dir)
        key, feats, frac = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], ["l_quantity", "l_discount"], 0.1
    width = len(feats)
    est = {
        "rf": (models.random_forest("label", seed=SEED), {"numTrees": [25, 50], "maxDepth": [5, 7], "maxBins": [64]}),
        "gbt": (models.gbt("label", seed=SEED), {"maxDepth": [3, 5], "stepSize": [0.1, 0.3], "maxIter": [20]}),
        "mlp": (models.mlp("label", [width, 5, 2], seed=SEED), {"layers": [[width, 5, 2], [width, 10, 2]], "maxIter": [50]}),
    }
    return jobs.compare_classifiers(df, key, "label", feats, est, sample_fraction=frac, seed=SEED)


def run_recommend(spark, args):
    if args.ratings_csv and args.movies_csv:
        ratings = readers.read_csv(spark, args.ratings_csv, readers.RATINGS_SCHEMA, header=True)
        movies = readers.read_csv(spark, args.movies_csv, readers.MOVIES_SCHEMA, header=True)
    else:
        ratings, movies = fixtures.ratings(spark, args.sf_dir), fixtures.movies(spark, args.sf_dir)
    return jobs.recommender_report(ratings, movies, seed=SEED)


RUNNERS = {"logs": run_logs, "claims": run_claims, "classify": run_classify, "recommend": run_recommend}


def main(argv=None):
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--out", required=True)
    p.add_argument("--jobs", default="logs,claims,classify,recommend")
    p.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    p.add_argument("--log")
    p.add_argument("--claims-csv")
    p.add_argument("--particles-csv")
    p.add_argument("--ratings-csv")
    p.add_argument("--movies-csv")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("corvid-jobs").getOrCreate()
    for name in args.jobs.split(","):
        reports = RUNNERS[name](spark, args)
        for report, df in reports.items():
            path = write_report(df, f"{args.out.rstrip('/')}/{name}/{report}", partitions=None)
            print(f"{name}/{report}: {path}")


if __name__ == "__main__":
    main()
