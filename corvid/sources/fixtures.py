"""Job-shaped inputs derived from the shared test tables.

Each builder reads the parquet tables and derives, with Spark, the input a
job expects (access log lines, insurance claims, particles, ratings,
movies).  The derivations are mirrored as SQL in ``corvid.plans.oracles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.functions.timefmt import ts_to_epoch
from corvid.session import spread_scan
from corvid.sources.readers import read_table

# Fixed values of the log rendering: country labels by user_id % 4 and the
# server's zone offset written into every line.
LOG_COUNTRIES = ["de", "ca", "sg", "com"]
LOG_ZONE = "-0400"


def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` rendered as Common Log Format lines (one ``value`` each)."""
    ev = spread_scan(read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"))
    country = F.element_at(F.array(*[F.lit(c) for c in LOG_COUNTRIES]), (F.col("user_id") % 4 + 1).cast("int"))
    host = F.concat(F.lit("h"), F.col("user_id").cast("string"), F.lit(".net."), country)
    size = F.when(F.col("event_type") == "error", F.lit("-")).otherwise(F.col("event_id").cast("string"))
    line = F.concat(
        host,
        F.lit(" - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(f" {LOG_ZONE}] \"GET /"),
        F.col("event_type"),
        F.lit(' HTTP/1.0" 200 '),
        size,
    )
    return ev.select(line.alias("value"))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order claims table: counts, derived label, numeric and categorical features."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    per_order = li.groupBy("l_orderkey").agg(
        F.sum((F.col("l_returnflag") == "R").cast("long")).alias("ClaimNb"),
        F.round(F.sum("l_quantity") / 500.0, 4).alias("Exposure"),
    )
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus"
    )
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return (
        orders.join(per_order, orders.o_orderkey == per_order.l_orderkey)
        .join(cust, orders.o_custkey == cust.c_custkey)
        .select(
            "o_orderkey",
            "ClaimNb",
            (F.col("ClaimNb") >= 3).cast("int").alias("hasClaim"),
            "Exposure",
            "o_totalprice",
            "c_acctbal",
            "o_orderpriority",
            "o_orderstatus",
            "c_mktsegment",
        )
    )


def particles_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Particle-style table from ``embeddings``: label + feature1..featureN, N the longest vector's length."""
    emb = read_table(spark, sf_dir, "embeddings")
    n_features = emb.agg(F.max(F.size("embedding"))).first()[0] or 0
    return emb.select(
        "vec_id",
        (F.col("label") % 2).cast("double").alias("label"),
        *[F.get("embedding", i).cast("double").alias(f"feature{i + 1}") for i in range(n_features)],
    )


def particles_separable(spark: SparkSession, sf_dir: str, threshold: float = 25.0) -> DataFrame:
    """Separable classification table: label = l_quantity > threshold."""
    li = spread_scan(read_table(spark, sf_dir, "lineitem"))
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        (F.col("l_quantity") > threshold).cast("double").alias("label"),
        "l_quantity",
        "l_discount",
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(userId, movieId, rating 0.5..5.0, timestamp epoch seconds)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("movieId"),
        (0.5 * (1 + F.floor((F.col("l_quantity") - 1) / 5))).cast("double").alias("rating"),
        ts_to_epoch("o_orderdate").cast("long").alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(movieId, title, genres '|'-separated) from ``part``."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return part.select(
        F.col("p_partkey").cast("int").alias("movieId"),
        F.col("p_name").alias("title"),
        F.regexp_replace("p_name", " ", "|").alias("genres"),
    )


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_custkey, n_regionkey, region_feature) for the clustering fixture."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
        "c_custkey", "n_regionkey", (F.col("n_regionkey") * 1000.0).alias("region_feature")
    )


def user_clusters_from_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster assignment table (id, prediction) with the region as the cluster."""
    return customer_regions(spark, sf_dir).select(
        F.col("c_custkey").cast("int").alias("id"), F.col("n_regionkey").cast("int").alias("prediction")
    )


def lineitem_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label, score) with many ties: label = returned, score = quantity."""
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    return li.select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.col("l_quantity").cast("double").alias("score"),
    )
