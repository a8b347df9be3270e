"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the shared test tables (or data Spark derives from them)
in full; fixture derivations live in ``corvid.sources.fixtures`` and are
mirrored in SQL by ``corvid.plans.oracles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.functions.timefmt import clean_round, epoch_to_ts, round6
from corvid.operators import clustering, dictionary, features, logs, metrics, models, recommend, sampling, tuning
from corvid.plans import jobs
from corvid.session import cut_lineage, persisted, scratch_path
from corvid.sources import fixtures, gzip_index, sinks
from corvid.sources.readers import MOVIES_SCHEMA, RATINGS_SCHEMA, read_csv, read_csv_checked, read_headerless_csv, read_text_lines

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


# --------------------------------------------------------------------- logs


def _parsed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.parse(fixtures.access_log_lines(spark, sf_dir))


@register("log_parse")
def q_log_parse(spark, sf_dir):
    """S1 + X5: render the log as gzip text in the shared scratch folder, scan it back, parse."""
    path = scratch_path(spark, "access-log")
    fixtures.access_log_lines(spark, sf_dir).write.option("compression", "gzip").text(path)
    lines = read_text_lines(spark, path, min_partitions=spark.sparkContext.defaultParallelism)
    return logs.parse(lines)


@register("log_parse_positional")
def q_log_parse_positional(spark, sf_dir):
    return logs.parse_positional(fixtures.access_log_lines(spark, sf_dir))


@register("host_suffix_filter")
def q_host_suffix_filter(spark, sf_dir):
    """F1 over a parsed log stored by country: the filter prunes partitions."""
    path = logs.write_parsed(_parsed_log(spark, sf_dir), scratch_path(spark, "parsed-log"))
    return logs.by_country(spark.read.parquet(path)).select("host", "country", "ts_text")


@register("country_requests")
def q_country_requests(spark, sf_dir):
    return logs.country_requests(_parsed_log(spark, sf_dir))


@register("country_unique_hosts")
def q_country_unique_hosts(spark, sf_dir):
    return logs.country_unique_hosts(_parsed_log(spark, sf_dir))


@register("country_summary")
def q_country_summary(spark, sf_dir):
    return logs.country_summary(_parsed_log(spark, sf_dir))


@register("top_hosts")
def q_top_hosts(spark, sf_dir):
    return logs.top_hosts(_parsed_log(spark, sf_dir), n=9)


@register("top_hosts_sketch")
def q_top_hosts_sketch(spark, sf_dir):
    """T2 by a frequency sketch over the stored log: only hosts that may be among the first are counted."""
    path = logs.write_parsed(_parsed_log(spark, sf_dir), scratch_path(spark, "parsed-log"))
    return logs.top_hosts_sketch(spark.read.parquet(path), n=9)


@register("top_hosts_bucketed")
def q_top_hosts_bucketed(spark, sf_dir):
    """The parsed log stored in buckets by (country, host), counted without an exchange of rows."""
    path = scratch_path(spark, "bucketed-log")
    table = "corvid_log_" + path.rsplit("-", 1)[-1]
    return logs.top_hosts(logs.store_bucketed(_parsed_log(spark, sf_dir), table, path, buckets=16), n=9)


@register("gzip_ranges")
def q_gzip_ranges(spark, sf_dir):
    """The log as one gzip file, indexed once, then inflated and parsed from several access points."""
    path, index = scratch_path(spark, "access-log-one"), scratch_path(spark, "access-log-index")
    fixtures.access_log_lines(spark, sf_dir).coalesce(1).write.option("compression", "gzip").text(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path").collect()
    points = gzip_index.build(spark, [r.path for r in files], index, span=64 << 10)
    return logs.parse(gzip_index.read_lines(points))


#: (first day, last day) of the reports from stored sketches.
DAY_RANGES = [(1, 7), (8, 14), (15, 31), (1, 31)]


@register("unique_hosts_by_range")
def q_unique_hosts_by_range(spark, sf_dir):
    """A2 from stored sketches of each hour: any range of days, without the log."""
    path = scratch_path(spark, "host-sketches")
    logs.host_sketches(_parsed_log(spark, sf_dir)).write.parquet(path)
    ranges = spark.createDataFrame(DAY_RANGES, "first_day int, last_day int")
    return logs.unique_hosts_in_ranges(spark.read.parquet(path), ranges)


@register("published_reports")
def q_published_reports(spark, sf_dir):
    """K7: the reports written to a snapshot that a manifest makes current, read back from there."""
    path = scratch_path(spark, "reports")
    parsed = _parsed_log(spark, sf_dir)
    sinks.publish({"top_hosts": logs.top_hosts(parsed, n=9), "requests": logs.country_requests(parsed)}, path)
    return sinks.read_published(spark, path, "top_hosts")


@register("heatmap_empty")
def q_heatmap_empty(spark, sf_dir):
    """a country without a host has an empty grid, and no error."""
    return logs.heatmap(_hourly(spark, sf_dir), countries=("xx",), dense=True, counts_col="requests")


@register("top_hosts_dedup")
def q_top_hosts_dedup(spark, sf_dir):
    return logs.top_hosts(_parsed_log(spark, sf_dir), n=9, dedup=True)


@register("host_share")
def q_host_share(spark, sf_dir):
    return logs.host_share(_parsed_log(spark, sf_dir), n=9)


@register("top_host")
def q_top_host(spark, sf_dir):
    return logs.top_host(_parsed_log(spark, sf_dir))


@register("day_range")
def q_day_range(spark, sf_dir):
    return logs.day_range(_parsed_log(spark, sf_dir))


@register("heatmap_country")
def q_heatmap_country(spark, sf_dir):
    return logs.heatmap(_parsed_log(spark, sf_dir), by="country")


def _hourly(spark, sf_dir):
    """Reports that need two passes (arg-max, then the rows of the winner)
    read the (country, host, day, hour) aggregate twice; the identical
    exchange is reused, so the log is scanned once."""
    return logs.hourly_counts(_parsed_log(spark, sf_dir))


@register("heatmap_top_host")
def q_heatmap_top_host(spark, sf_dir):
    return logs.heatmap(_hourly(spark, sf_dir), by="top_host", counts_col="requests")


@register("heatmap_dense")
def q_heatmap_dense(spark, sf_dir):
    return logs.heatmap(_hourly(spark, sf_dir), by="top_host", dense=True, counts_col="requests")


@register("heatmap_pivot")
def q_heatmap_pivot(spark, sf_dir):
    grid = logs.heatmap(_parsed_log(spark, sf_dir), by="country")
    return logs.pivot_grid(grid, ["country", "hour"], "day", range(1, 32))


# ---------------------------------------------------------------- sampling

SEED = 4711


def _claims(spark, sf_dir):
    return fixtures.claims(spark, sf_dir)


@register("claims_label")
def q_claims_label(spark, sf_dir):
    return _claims(spark, sf_dir).select("o_orderkey", "ClaimNb", "hasClaim")


@register("class_counts")
def q_class_counts(spark, sf_dir):
    return sampling.class_counts(_claims(spark, sf_dir), "hasClaim")


@register("class_proportions")
def q_class_proportions(spark, sf_dir):
    p = sampling.class_proportions(_claims(spark, sf_dir), "hasClaim")
    return p.withColumn("share", round6("share"))


@register("class_weights")
def q_class_weights(spark, sf_dir):
    w = sampling.class_weights(_claims(spark, sf_dir).select("o_orderkey", "hasClaim"), "hasClaim")
    return w.withColumn("classWeights", round6("classWeights"))


@register("hash_split")
def q_hash_split(spark, sf_dir):
    c = _claims(spark, sf_dir).select("o_orderkey", "hasClaim")
    return sampling.hash_split(c, "o_orderkey", [0.7, 0.3], seed=SEED)


@register("hash_sample")
def q_hash_sample(spark, sf_dir):
    c = _claims(spark, sf_dir).select("o_orderkey", "hasClaim")
    return sampling.hash_sample(c, "o_orderkey", 0.1, seed=SEED)


@register("sample_of_split")
def q_sample_of_split(spark, sf_dir):
    """A tenth of each part of a split: the rate must not depend on the split."""
    c = sampling.hash_split(_claims(spark, sf_dir), "o_orderkey", [0.8, 0.2], seed=SEED)
    kept = sampling.hash_sample(c, "o_orderkey", 0.1, seed=SEED).groupBy("split").agg(F.count("*").alias("kept"))
    got = c.groupBy("split").agg(F.count("*").alias("n")).join(kept, "split", "left")
    rate = F.abs(F.col("kept") / F.col("n") - 0.1) < 5 * F.sqrt(F.lit(0.09) / F.col("n"))
    return got.select("split", "n", "kept", rate.alias("rate_as_asked"))


@register("stratified_sample")
def q_stratified_sample(spark, sf_dir):
    c = _claims(spark, sf_dir).select("o_orderkey", "hasClaim")
    return sampling.stratified_sample(c, "o_orderkey", "hasClaim", {0: 0.2, 1: 0.5}, seed=SEED)


@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    c = _claims(spark, sf_dir).select("o_orderkey", "hasClaim")
    return sampling.stratified_split(c, "o_orderkey", "hasClaim", [0.7, 0.3], seed=SEED, exact=True)


@register("kfold_assign")
def q_kfold_assign(spark, sf_dir):
    c = _claims(spark, sf_dir).select("o_orderkey", "hasClaim")
    return sampling.kfold(c, "o_orderkey", 5, seed=SEED)


@register("union_strata")
def q_union_strata(spark, sf_dir):
    c = _claims(spark, sf_dir).select("o_orderkey", "hasClaim")
    pos = sampling.hash_sample(c.filter(F.col("hasClaim") == 1), "o_orderkey", 0.5, seed=SEED)
    neg = sampling.hash_sample(c.filter(F.col("hasClaim") == 0), "o_orderkey", 0.2, seed=SEED)
    return sampling.union_parts([pos, neg])


RATING_ORDER = ["timestamp", "userId", "movieId", "rating"]


def _ratings(spark, sf_dir):
    return fixtures.ratings(spark, sf_dir)


@register("chrono_split")
def q_chrono_split(spark, sf_dir):
    return sampling.chrono_split(_ratings(spark, sf_dir), RATING_ORDER, [0.4, 0.6, 0.8])


@register("chrono_cuts_many")
def q_chrono_cuts_many(spark, sf_dir):
    """B1 with nine cuts, found in one search."""
    return sampling.chrono_split(_ratings(spark, sf_dir), RATING_ORDER, [f / 10 for f in range(1, 10)])


@register("except_digest")
def q_except_digest(spark, sf_dir):
    """U2 by row digests."""
    r = _ratings(spark, sf_dir)
    marked = sampling.chrono_split(r, RATING_ORDER, [0.4])
    return sampling.except_digest(r, marked.filter("train_40").drop("train_40"))


@register("ordered_export")
def q_ordered_export(spark, sf_dir):
    """Ratings in files that are globally in order; their first column has ten values, so every key is hot."""
    path = sinks.write_ordered(_ratings(spark, sf_dir), scratch_path(spark, "ordered"), ["rating", "userId", "movieId", "timestamp"], files=8)
    return sinks.read_positions(spark, path)


@register("except_distinct")
def q_except_distinct(spark, sf_dir):
    r = _ratings(spark, sf_dir)
    marked = sampling.chrono_split(r, RATING_ORDER, [0.4])
    train = marked.filter("train_40").drop("train_40")
    return sampling.except_distinct(r, train)


@register("distinct_rows")
def q_distinct_rows(spark, sf_dir):
    return _ratings(spark, sf_dir).distinct()


@register("epoch_to_ts")
def q_epoch_to_ts(spark, sf_dir):
    r = _ratings(spark, sf_dir)
    return r.select("userId", "movieId", "timestamp", epoch_to_ts("timestamp").alias("ts"))


# ----------------------------------------------------------------- metrics

AUC_SCORES = ["l_discount", "l_quantity", "l_extendedprice"]


def _baseline_predictions(spark, sf_dir):
    """Ratings scored by two deterministic baselines: movie mean and user mean."""
    r = _ratings(spark, sf_dir)
    movie = r.groupBy("movieId").agg(F.avg("rating").alias("movie_mean"))
    user = r.groupBy("userId").agg(F.avg("rating").alias("user_mean"))
    return r.join(movie, "movieId").join(user, "userId")


@register("regression_metrics")
def q_regression_metrics(spark, sf_dir):
    p = _baseline_predictions(spark, sf_dir)
    m = metrics.regression_metrics(p, "rating", "movie_mean")
    return m.select("n", *[clean_round(c, 8).alias(c) for c in ("rmse", "mse", "mae")])


def _metric_report(spark, sf_dir):
    p = _baseline_predictions(spark, sf_dir)
    stacked = p.select("rating", F.lit("movie_mean").alias("setting"), F.col("movie_mean").alias("prediction")).unionByName(
        p.select("rating", F.lit("user_mean").alias("setting"), F.col("user_mean").alias("prediction"))
    )
    m = metrics.regression_metrics(stacked, "rating", "prediction", group_by=["setting"])
    return m.select("setting", "n", *[clean_round(c, 8).alias(c) for c in ("rmse", "mse", "mae")])


@register("metric_report")
def q_metric_report(spark, sf_dir):
    return _metric_report(spark, sf_dir)


@register("metric_pivot")
def q_metric_pivot(spark, sf_dir):
    long = metrics.metric_long(_metric_report(spark, sf_dir), ["setting"], ["rmse", "mse", "mae"])
    return long.groupBy("metric").pivot("setting", ["movie_mean", "user_mean"]).agg(F.first("value"))


@register("auc_exact")
def q_auc_exact(spark, sf_dir):
    a = metrics.auc_exact(fixtures.lineitem_scores(spark, sf_dir), "label", "score")
    return a.select(clean_round("auc", 9).alias("auc"), "positives", "negatives")


@register("auc_near_unique")
def q_auc_near_unique(spark, sf_dir):
    """AUC over nearly as many scores as rows; every 13th order has none."""
    li = fixtures.read_table(spark, sf_dir, "lineitem")
    score = F.when(F.col("l_orderkey") % 13 != 0, F.col("l_extendedprice").cast("double"))
    a = metrics.auc_exact(li.select((F.col("l_returnflag") == "R").cast("double").alias("label"), score.alias("score")))
    return a.select(clean_round("auc", 9).alias("auc"), "positives", "negatives")


@register("auc_by_group")
def q_auc_by_group(spark, sf_dir):
    """W4 of several scores of the same rows at once, one with ten values, one with nearly as many as rows."""
    li = fixtures.read_table(spark, sf_dir, "lineitem")
    li = li.select((F.col("l_returnflag") == "R").cast("double").alias("label"), *(F.col(c).cast("double").alias(c) for c in AUC_SCORES))
    stacked = li.unpivot(["label"], AUC_SCORES, "model", "score")
    a = metrics.auc_by_group(stacked, ["model"])
    return a.select("model", clean_round("auc", 9).alias("auc"), "positives", "negatives")


@register("metric_override")
def q_metric_override(spark, sf_dir):
    """One metric a call, each asked for by name."""
    p = _baseline_predictions(spark, sf_dir)
    m = metrics.metric_table([metrics.regression_metric(p, name, "rating", "movie_mean") for name in ("rmse", "mse", "mae")])
    return m.select("metric", clean_round("value", 8).alias("value"))


def _hard_predictions(spark, sf_dir):
    s = fixtures.lineitem_scores(spark, sf_dir)
    return s.withColumn("prediction", (F.col("score") > 25).cast("double"))


@register("balanced_accuracy")
def q_balanced_accuracy(spark, sf_dir):
    b = metrics.balanced_accuracy(_hard_predictions(spark, sf_dir))
    return b.withColumn("balanced_accuracy", clean_round("balanced_accuracy", 9))


@register("accuracy")
def q_accuracy(spark, sf_dir):
    a = metrics.accuracy(_hard_predictions(spark, sf_dir))
    return a.withColumn("accuracy", clean_round("accuracy", 9))


# ------------------------------------------------------ recommendation taste


def _clusters(spark, sf_dir):
    return fixtures.user_clusters_from_regions(spark, sf_dir)


def _cluster_high(spark, sf_dir):
    rated = recommend.cluster_ratings(_ratings(spark, sf_dir), _clusters(spark, sf_dir))
    return recommend.high_rated_movies(rated, 4.0)


@register("cluster_ratings")
def q_cluster_ratings(spark, sf_dir):
    return recommend.cluster_ratings(_ratings(spark, sf_dir), _clusters(spark, sf_dir))


@register("high_rated_movies")
def q_high_rated_movies(spark, sf_dir):
    return _cluster_high(spark, sf_dir).withColumn("avg_rating", round6("avg_rating"))


@register("top_movies")
def q_top_movies(spark, sf_dir):
    t = recommend.top_movies(_cluster_high(spark, sf_dir), fixtures.movies(spark, sf_dir), 5)
    return t.withColumn("avg_rating", round6("avg_rating"))


@register("movie_genres")
def q_movie_genres(spark, sf_dir):
    return recommend.movie_genres(_cluster_high(spark, sf_dir), fixtures.movies(spark, sf_dir))


@register("top_genres")
def q_top_genres(spark, sf_dir):
    g = recommend.movie_genres(_cluster_high(spark, sf_dir), fixtures.movies(spark, sf_dir))
    return recommend.top_genres(g, 10)


@register("top_clusters")
def q_top_clusters(spark, sf_dir):
    return recommend.top_clusters(_clusters(spark, sf_dir), 5)


@register("largest_cluster")
def q_largest_cluster(spark, sf_dir):
    return recommend.largest_cluster(_clusters(spark, sf_dir))


# ---------------------------------------------------------------- k-means


def _kmeans_regions(spark, sf_dir):
    cr = fixtures.customer_regions(spark, sf_dir)
    vec = clustering.as_vector(cr, ["region_feature"])
    assigned = clustering.kmeans_assign(vec, k=5, seed=SEED)
    return clustering.name_by_smallest_member(assigned, "c_custkey")


@register("kmeans_assign")
def q_kmeans_assign(spark, sf_dir):
    return _kmeans_regions(spark, sf_dir).select("c_custkey", "cluster")


@register("kmeans_top_clusters")
def q_kmeans_top_clusters(spark, sf_dir):
    return recommend.top_clusters(_kmeans_regions(spark, sf_dir), 5, cluster_col="cluster")


# --------------------------------------------------------------- features

NUMERIC = ["Exposure", "o_totalprice", "c_acctbal"]
CATEGORICAL = ["o_orderpriority", "o_orderstatus", "c_mktsegment"]


@register("assemble_features")
def q_assemble_features(spark, sf_dir):
    df = features.assemble(_claims(spark, sf_dir), NUMERIC, "num_features")
    return df.select("o_orderkey", *features.vector_columns(df, "num_features", len(NUMERIC)))


def _scaled(spark, sf_dir, with_mean):
    c = features.assemble(_claims(spark, sf_dir), NUMERIC, "num_features")
    with persisted(c) as cached:
        model = features.scaler("num_features", "scaled", with_mean=with_mean).fit(cached)
    out = model.transform(c)
    return out.select("o_orderkey", *features.vector_columns(out, "scaled", len(NUMERIC)))


@register("standard_scale")
def q_standard_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, True)


@register("scale_sd_only")
def q_scale_sd_only(spark, sf_dir):
    return _scaled(spark, sf_dir, False)


@register("string_index")
def q_string_index(spark, sf_dir):
    c = _claims(spark, sf_dir)
    # ClaimNb: a numeric column treated as a category (indexed by its text).
    cats = CATEGORICAL + ["ClaimNb"]
    out = features.indexer(cats, handle_invalid="error").fit(c).transform(c)
    return out.select("o_orderkey", *[F.col(f"{x}_index").cast("int").alias(f"{x}_index") for x in cats])


@register("dictionary_index")
def q_dictionary_index(spark, sf_dir):
    """E4/E5 with dictionaries as tables: one column with a value for each row, one with five values, one numeric."""
    c = _claims(spark, sf_dir).select("o_orderkey", "c_mktsegment", "ClaimNb")
    out = dictionary.fit_apply(c, ["o_orderkey", "c_mktsegment", "ClaimNb"])
    return out.select("o_orderkey", "o_orderkey_index", "c_mktsegment_index", "ClaimNb_index")


@register("one_hot")
def q_one_hot(spark, sf_dir):
    c = _claims(spark, sf_dir)
    stages = [features.indexer(["o_orderpriority"], "keep"), features.one_hot(["o_orderpriority"])]
    out = Pipeline(stages=stages).fit(c).transform(c)
    width = features.vector_width(out, "o_orderpriority_onehot")
    return out.select("o_orderkey", *features.vector_columns(out, "o_orderpriority_onehot", width, prefix="oh", digits=None))


def _design(spark, sf_dir, encode):
    c = _claims(spark, sf_dir)
    c = sampling.hash_split(c, "o_orderkey", [0.7, 0.3], seed=SEED)
    pipe = features.feature_pipeline(NUMERIC, CATEGORICAL, encode=encode)
    with persisted(c.filter(F.col("split") == "train")) as train:
        model = pipe.fit(train)
    scored = model.transform(c)
    width = features.vector_width(scored, "features")
    return scored.select("o_orderkey", *features.vector_columns(scored, "features", width))


@register("ordinal_features")
def q_ordinal_features(spark, sf_dir):
    return _design(spark, sf_dir, "ordinal")


@register("feature_pipeline")
def q_feature_pipeline(spark, sf_dir):
    return _design(spark, sf_dir, "onehot")


# ------------------------------------------------------------------ models


def _one_category_design(spark, sf_dir, cat="o_orderpriority"):
    """Saturated design: dummies of one category (drop-last) + intercept."""
    c = _claims(spark, sf_dir)
    stages = [
        features.indexer([cat], handle_invalid="error"),
        features.one_hot([cat]),
        features.assembler([f"{cat}_onehot"], "features"),
    ]
    with persisted(c) as cached:
        model = Pipeline(stages=stages).fit(cached)
    return model, model.transform(c)


@register("poisson_fit")
def q_poisson_fit(spark, sf_dir):
    _, d = _one_category_design(spark, sf_dir)
    with persisted(d) as cached:
        fit = models.poisson("ClaimNb", regParam=0.0, tol=1e-10, maxIter=50).fit(cached)
    pred = fit.transform(d)
    return pred.groupBy("o_orderpriority").agg(clean_round(F.avg("prediction"), 5).alias("mean_prediction"))


@register("logistic_fit")
def q_logistic_fit(spark, sf_dir):
    _, d = _one_category_design(spark, sf_dir)
    with persisted(d) as cached:
        fit = models.logistic("hasClaim", regParam=0.0, tol=1e-10, maxIter=300).fit(cached)
    pred = models.positive_probability(fit.transform(d))
    return pred.groupBy("o_orderpriority").agg(clean_round(F.avg("p1"), 4).alias("p_hat"))


@register("logistic_weighted")
def q_logistic_weighted(spark, sf_dir):
    _, d = _one_category_design(spark, sf_dir)
    d = sampling.class_weights(d, "hasClaim")
    with persisted(d) as cached:
        fit = models.logistic("hasClaim", weight="classWeights", regParam=0.0, tol=1e-10, maxIter=300).fit(cached)
    pred = models.positive_probability(fit.transform(d))
    return pred.groupBy("o_orderpriority").agg(clean_round(F.avg("p1"), 4).alias("p_hat"))


@register("coefficient_report")
def q_coefficient_report(spark, sf_dir):
    pipe, d = _one_category_design(spark, sf_dir)
    with persisted(d) as cached:
        fit = models.poisson("ClaimNb", regParam=0.0, tol=1e-10, maxIter=50).fit(cached)
    labels = list(pipe.stages[0].labelsArray[0])
    table = models.coefficient_table(spark, fit, labels[: len(labels) - 1])
    return table.select("term", clean_round("coefficient", 5).alias("coefficient"))


def _penalised(spark, sf_dir, penalty, reg):
    c = _claims(spark, sf_dir)
    with persisted(c) as cached:
        d = features.feature_pipeline(NUMERIC, CATEGORICAL).fit(cached).transform(cached)
        fit = models.logistic("hasClaim", penalty=penalty, regParam=reg, maxIter=200).fit(d)
    coefs = [float(x) for x in fit.coefficients.toArray()]
    vals = spark.createDataFrame(
        [(penalty, max(abs(x) for x in coefs), float(fit.intercept))], "penalty string, max_abs double, b0 double"
    )
    return vals.select(
        "penalty", clean_round("max_abs", 4).alias("max_abs_coefficient"), clean_round("b0", 3).alias("intercept")
    )


@register("logistic_l1")
def q_logistic_l1(spark, sf_dir):
    return _penalised(spark, sf_dir, "l1", 10.0)


@register("logistic_l2")
def q_logistic_l2(spark, sf_dir):
    return _penalised(spark, sf_dir, "l2", 1e5)


@register("logistic_l2_optimum")
def q_logistic_l2_optimum(spark, sf_dir):
    """M4 at a moderate penalty: the gradient of loss plus penalty is zero in every slot.

    MLlib penalises the coefficients of features scaled to a standard
    deviation of one, so slot j must have avg((p - y) x_j) = -reg * b_j * sd_j^2;
    another penalty, or another strength, leaves a residual.
    """
    reg = 0.02
    c = _claims(spark, sf_dir)
    design = features.feature_pipeline(NUMERIC, CATEGORICAL).fit(c).transform(c)
    with persisted(design.select("hasClaim", "features")) as d:
        fit = models.logistic("hasClaim", penalty="l2", regParam=reg, tol=1e-12, maxIter=500).fit(d)
        x = vector_to_array(F.col("features"))
        rows = models.positive_probability(fit.transform(d)).select((F.col("p1") - F.col("hasClaim")).alias("r"), F.posexplode(x).alias("slot", "x"))
        got = rows.groupBy("slot").agg(F.avg(F.col("r") * F.col("x")).alias("g"), F.var_samp("x").alias("v"), F.max(F.abs("x")).alias("top")).collect()  # a row a slot
    b = fit.coefficients.toArray()
    out = [(r["slot"], bool(abs(r["g"] + reg * b[r["slot"]] * r["v"]) < 1e-6), bool(abs(b[r["slot"]]) > 0)) for r in got]
    return spark.createDataFrame(out, "slot int, stationary boolean, not_zero boolean")


SEPARABLE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _separable(spark, sf_dir, threshold=25.0):
    s = fixtures.particles_separable(spark, sf_dir, threshold)
    s = sampling.hash_split(s, SEPARABLE_KEY, [0.8, 0.2], seed=SEED)
    return features.assemble(s, ["l_quantity", "l_discount"], "features")


def _classify(spark, sf_dir, est):
    s = _separable(spark, sf_dir)
    with persisted(s.filter(F.col("split") == "train").select("label", "features")) as train:
        model = est.fit(train)
    pred = model.transform(s.filter(F.col("split") == "test"))
    return pred.select(*SEPARABLE_KEY, "label", "prediction")


@register("random_forest")
def q_random_forest(spark, sf_dir):
    return _classify(spark, sf_dir, models.random_forest("label", numTrees=20, maxDepth=4, maxBins=64, seed=SEED))


@register("gbt")
def q_gbt(spark, sf_dir):
    return _classify(spark, sf_dir, models.gbt("label", maxIter=10, maxDepth=3, maxBins=64, seed=SEED))


@register("mlp")
def q_mlp(spark, sf_dir):
    mlp = models.mlp("label", [2, 5, 2], features="scaled", maxIter=300, seed=SEED, tol=1e-9)
    pipe = Pipeline(stages=[features.scaler("features", "scaled"), mlp])
    return _classify(spark, sf_dir, pipe)


def _cv_rows(spark, sf_dir):
    """All rows with their split, and what a fit needs of the training rows."""
    s = _separable(spark, sf_dir, threshold=40.0)
    train = sampling.kfold(s.filter(F.col("split") == "train"), SEPARABLE_KEY, 5, seed=SEED)
    return s, train.select("label", "features", "fold")


def _cv(train):
    rf = models.random_forest("label", numTrees=5, maxBins=64, seed=SEED)
    grid = tuning.param_grid(rf, {"maxDepth": [0, 2]})
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    cvm = tuning.cross_validate(rf, grid, ev, train, fold_col="fold")
    return rf, grid, cvm


@register("cross_validate")
def q_cross_validate(spark, sf_dir):
    _, grid, cvm = _cv(_cv_rows(spark, sf_dir)[1])
    rep = tuning.cv_report(spark, cvm, grid)
    return rep.select("setting", "param", "value", clean_round("avg_metric", 6).alias("avg_metric"), "is_best")


@register("cv_report")
def q_cv_report(spark, sf_dir):
    """V4: the chosen parameters of the best model, from its public param map."""
    _, _, cvm = _cv(_cv_rows(spark, sf_dir)[1])
    best = tuning.best_params(cvm, ["maxDepth", "numTrees", "maxBins"])
    rows = [(k, str(v)) for k, v in sorted(best.items())]
    return spark.createDataFrame(rows, "param string, value string")


@register("refit_best")
def q_refit_best(spark, sf_dir):
    s, rows = _cv_rows(spark, sf_dir)
    with persisted(rows) as train:
        rf, _, cvm = _cv(train)
        model = tuning.refit_best(rf, tuning.best_params(cvm, ["maxDepth"]), train)
    pred = model.transform(s.filter(F.col("split") == "test"))
    return pred.select(*SEPARABLE_KEY, "label", "prediction")


@register("cv_pipeline")
def q_cv_pipeline(spark, sf_dir):
    """V3: the whole pipeline is cross-validated, its scaler fitted anew in each fold."""
    _, train = _cv_rows(spark, sf_dir)
    rf = models.random_forest("label", features="scaled", numTrees=5, maxBins=64, seed=SEED)
    grid = tuning.param_grid(rf, {"maxDepth": [0, 2]})
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    cvm = tuning.cross_validate(Pipeline(stages=[features.scaler("features", "scaled"), rf]), grid, ev, train, fold_col="fold")
    rep = tuning.cv_report(spark, cvm, grid)
    return rep.select("setting", "param", "value", clean_round("avg_metric", 6).alias("avg_metric"), "is_best")


@register("compare_classifiers")
def q_compare_classifiers(spark, sf_dir):
    """Settings chosen on a sample, refitted on all training rows, judged on the test part."""
    estimators = {
        "random_forest": (models.random_forest("label", numTrees=5, maxBins=64, seed=SEED), {"maxDepth": [1, 2]}),
        "gbt": (models.gbt("label", maxBins=64, seed=SEED, maxDepth=2), {"maxIter": [2]}),
    }
    rows = fixtures.particles_separable(spark, sf_dir)
    out = jobs.compare_classifiers(
        rows, SEPARABLE_KEY, "label", ["l_quantity", "l_discount"], estimators, sample_fraction=0.2, folds=2, seed=SEED
    )
    return out["metrics"].select("model", "metric", clean_round("value", 6).alias("value"))


@register("compare_networks")
def q_compare_networks(spark, sf_dir):
    """C6 with the network's layers as an axis: the classes are an interval and its outside, which no network without a hidden layer tells apart."""
    rows = fixtures.particles_separable(spark, sf_dir)
    inside = F.col("l_quantity").between(16, 35)
    rows = rows.withColumn("label", inside.cast("double")).withColumn("x", (F.col("l_quantity") - 25.5) / 15.0)
    network = models.mlp("label", [1, 2], maxIter=400, tol=1e-10, seed=SEED)
    out = jobs.compare_classifiers(rows, SEPARABLE_KEY, "label", ["x"], {"mlp": (network, {"layers": [[1, 2], [1, 8, 2]]})}, sample_fraction=0.3, folds=2, seed=SEED)
    best = out["cv"].filter("is_best").select("model", F.concat(F.lit("best "), "param").alias("metric"), F.col("value").cast("string").alias("value"))
    scores = out["metrics"].select("model", "metric", F.when(clean_round("value", 3) == 1.0, "1").otherwise(F.col("value").cast("string")).alias("value"))
    return best.unionByName(scores)


@register("claims_models_rates")
def q_claims_models_rates(spark, sf_dir):
    """C5 without a penalty on one category: the models must give each category's rates of the training part.

    Poisson with the exposure as offset predicts exposure times claims per
    exposure; another family, or no offset, predicts something else.
    """
    out = jobs.claims_models(_claims(spark, sf_dir), "o_orderkey", [], ["o_orderstatus"], reg_grid=[0.0], folds=2, seed=SEED, exposure_offset="Exposure")
    return out["metrics"].select("model", "metric", clean_round("value", 3).alias("value"))


@register("claims_models")
def q_claims_models(spark, sf_dir):
    """C5 with a penalty that leaves the base rate: every L1 score is the same, on the whole exact test part."""
    out = jobs.claims_models(_claims(spark, sf_dir), "o_orderkey", NUMERIC, CATEGORICAL, reg_grid=[10.0], folds=2, seed=SEED)
    m = out["metrics"].filter(F.col("model") == "logistic_l1")
    return m.select("model", "metric", clean_round("value", 6).alias("value"))


# --------------------------------------------------------------------- ALS


def _als_train_test(ratings):
    """Chronological protocol: the first 80 % of (persisted) ratings train, the
    distinct (user, film) pairs of the rest are scored."""
    marked = sampling.chrono_split(ratings, RATING_ORDER, [0.8], persist_keys=False)
    train = marked.filter("train_80").drop("train_80")
    test = marked.filter("NOT train_80").select("userId", "movieId").distinct()
    return train, test


@register("als_known_pairs")
def q_als_known_pairs(spark, sf_dir):
    with persisted(_ratings(spark, sf_dir)) as ratings:
        train, test = _als_train_test(ratings)
        model = recommend.als(seed=SEED, blocks=recommend.BLOCKS).fit(train)
        test = cut_lineage(test)
    return model.transform(test).select("userId", "movieId")


@register("als_factors")
def q_als_factors(spark, sf_dir):
    with persisted(_ratings(spark, sf_dir)) as ratings:
        train, _ = _als_train_test(ratings)
        model = recommend.als(seed=SEED, blocks=recommend.BLOCKS).fit(train)
    return model.userFactors.select("id", F.size("features").alias("n_factors"))


ALS_SETTINGS = {"setting1": {}, "setting2": {"regParam": 0.05}}


def _planted_ratings(spark, sf_dir):
    """Every rating is a user's leaning times a film's worth: a table of rank one."""
    r = _ratings(spark, sf_dir)
    leaning = 0.5 + 0.5 * F.pmod("userId", F.lit(3))
    worth = 1 + F.pmod("movieId", F.lit(5)) * 0.5
    return r.withColumn("rating", (leaning * worth).cast("double"))


@register("als_quality")
def q_als_quality(spark, sf_dir):
    """C7 on the planted table: the errors agree with each other and stay well below those of a film's mean."""
    ratings = _planted_ratings(spark, sf_dir)
    fractions = [0.4, 0.6, 0.8]
    table, _ = recommend.evaluate_over_splits(ratings, RATING_ORDER, fractions, ALS_SETTINGS, seed=SEED)
    # the films' means over all ratings, so a lower bound of what any train part's means reach
    means = ratings.groupBy("movieId").agg(F.avg("rating").alias("prediction"))
    base = metrics.regression_metrics(ratings.join(means, "movieId"), "rating", "prediction").first()["rmse"]
    return table.select(
        "fraction",
        "setting",
        "n",
        (F.abs(F.col("mse") - F.col("rmse") * F.col("rmse")) < 1e-9).alias("mse_is_rmse_squared"),
        ((F.col("mae") > 0) & (F.col("mae") <= F.col("rmse"))).alias("mae_within_rmse"),
        (F.col("rmse") < F.lit(0.5 * base)).alias("halves_the_error_of_means"),
    )


@register("als_reconstruction")
def q_als_reconstruction(spark, sf_dir):
    """The factors of users and films give back planted ratings of rank one, for users of each leaning."""
    ratings = _planted_ratings(spark, sf_dir).select("userId", "movieId", "rating")
    with persisted(ratings) as cached:
        model = recommend.als(seed=SEED, rank=2, regParam=0.001, maxIter=20).fit(cached)
    users = model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("u"))
    films = model.itemFactors.select(F.col("id").alias("movieId"), F.col("features").alias("f"))
    dot = F.aggregate(F.zip_with("u", "f", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda t, x: t + x)
    pairs = ratings.join(users, "userId").join(films, "movieId")
    scored = pairs.groupBy(F.pmod("userId", F.lit(3)).alias("leaning")).agg(F.count("*").alias("n"), F.sqrt(F.avg((dot - F.col("rating")) ** 2)).alias("rmse"))
    return scored.select("leaning", "n", (F.col("rmse") < 0.05).alias("given_back"))


@register("als_scored_counts")
def q_als_scored_counts(spark, sf_dir):
    """C7 row keys: test rows scored per split and setting (cold-start rows dropped)."""
    table, _ = recommend.evaluate_over_splits(_ratings(spark, sf_dir), RATING_ORDER, [0.4, 0.6, 0.8], ALS_SETTINGS, seed=SEED)
    return table.select("fraction", "setting", "n")


@register("als_user_clusters")
def q_als_user_clusters(spark, sf_dir):
    """C8 on the planted table: the clusters of the user factors are the groups of equal leaning."""
    _, fitted = recommend.evaluate_over_splits(
        _planted_ratings(spark, sf_dir), RATING_ORDER, [0.8], {"setting2": ALS_SETTINGS["setting2"]}, seed=SEED
    )
    factors = recommend.user_factor_vectors(fitted[(0.8, "setting2")])
    assigned = clustering.kmeans_assign(factors, k=3, seed=SEED).select("id", "prediction")
    named = clustering.name_by_smallest_member(assigned, "id")
    return recommend.top_clusters(named, 5, "cluster")


# ------------------------------------------------------------------- scans


@register("csv_headerless_scan")
def q_csv_headerless_scan(spark, sf_dir):
    """S2 + P3: particles written as headerless CSV in the shared scratch folder, read back by schema."""
    path = scratch_path(spark, "particles-csv")
    wide = fixtures.particles_wide(spark, sf_dir).drop("vec_id")
    wide.write.option("header", False).csv(path)
    df = read_headerless_csv(spark, path, wide.columns)
    return df.select("label", *[clean_round(c, 5).alias(c) for c in wide.columns[1:]])


@register("films_csv_scan")
def q_films_csv_scan(spark, sf_dir):
    """S3: films as CSV with a header; titles hold commas and quotes, so they are quoted."""
    path = scratch_path(spark, "films-csv")
    title = F.concat(F.lit('The "'), F.regexp_replace("title", " ", ", "), F.lit('" (1995)'))
    fixtures.movies(spark, sf_dir).withColumn("title", title).write.option("header", True).option("escape", '"').csv(path)
    return read_csv(spark, path, MOVIES_SCHEMA, header=True, escape='"')


@register("csv_header_scan")
def q_csv_header_scan(spark, sf_dir):
    """S3: ratings written as CSV with a header, read back with a fixed schema."""
    path = scratch_path(spark, "ratings-csv")
    _ratings(spark, sf_dir).write.option("header", True).csv(path)
    return read_csv(spark, path, RATINGS_SCHEMA, header=True)


def _damaged_ratings(spark, sf_dir):
    """Ratings as CSV text, some lines with a word for a number, a field too few or too many."""
    path = scratch_path(spark, "damaged-csv")
    fields = [F.col(c).cast("string") for c in ("userId", "movieId", "rating", "timestamp")]
    line = (
        F.when(F.col("userId") % 29 == 0, F.concat_ws(",", *fields[:2], F.lit("bad"), fields[3]))
        .when(F.col("userId") % 31 == 0, F.concat_ws(",", *fields[:3]))
        .when(F.col("userId") % 37 == 0, F.concat_ws(",", *fields, F.lit("x")))
        .when(F.col("userId") % 41 == 0, F.concat_ws(",", *fields[:3], F.lit("")))
        .otherwise(F.concat_ws(",", *fields))
    )
    _ratings(spark, sf_dir).select(line.alias("value")).write.text(path)
    return read_csv_checked(spark, path, RATINGS_SCHEMA)


@register("csv_rejects")
def q_csv_rejects(spark, sf_dir):
    """The lines of a damaged CSV that do not fit the schema, with reasons."""
    _, rejects = _damaged_ratings(spark, sf_dir)
    return rejects.select("line", "reason")


@register("csv_good_rows")
def q_csv_good_rows(spark, sf_dir):
    """The rows of a damaged CSV that do fit."""
    good, _ = _damaged_ratings(spark, sf_dir)
    return good
