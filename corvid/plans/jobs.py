"""Composite jobs (the user-facing surface): each returns named report
DataFrames built from the operators, sharing one parse / one aggregate /
one persisted training frame instead of rescanning inputs per report.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators import clustering, features, logs, metrics, models, recommend, sampling, tuning
from corvid.session import cut_lineage, persisted

# ------------------------------------------------------------------ C1-C4


def log_report(
    lines: DataFrame,
    n: int = 9,
    countries: Sequence[str] = logs.DEFAULT_COUNTRIES,
    dense: bool = True,
) -> dict[str, DataFrame]:
    """Traffic, unique and top hosts, share with rest and heat grids.

    The log is parsed once and reduced to (country, host, day, hour,
    requests), which is persisted; every report is derived from that
    aggregate, so the raw lines are scanned exactly once.
    """
    hourly = logs.hourly_counts(logs.parse(lines), countries).persist(StorageLevel.MEMORY_AND_DISK)
    kw = {"countries": countries, "counts_col": "requests"}
    return {
        "hourly": hourly,
        "summary": logs.country_summary(hourly, **kw),
        "top_hosts": logs.top_hosts(hourly, n, **kw),
        "host_share": logs.host_share(hourly, n, **kw),
        "heatmap_country": logs.heatmap(hourly, by="country", dense=dense, **kw),
        "heatmap_top_host": logs.heatmap(hourly, by="top_host", dense=dense, **kw),
    }


# --------------------------------------------------------------------- C5


def claims_models(
    claims: DataFrame,
    key: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    count_label: str = "ClaimNb",
    binary_label: str = "hasClaim",
    reg_grid: Sequence[float] = (0.001, 0.01, 0.1, 1.0, 10.0),
    folds: int = 5,
    seed: int = 0,
    train_fraction: float = 0.7,
    exposure_offset: str | None = None,
) -> dict[str, DataFrame]:
    """Poisson frequency model and L1/L2 claim-occurrence models.

    ``exposure_offset`` names an exposure column to enter the Poisson model
    as ``log(exposure)`` offset (a rate model) instead of only as a feature.

    Exact stratified split; each model is cross-validated *as a pipeline*
    (features refitted per fold, no leak) and each penalty gets its own
    regParam; refit on the whole training part (the best model of the cross
    validation); scored on the whole test part.  Both parts are persisted
    for all fits and scores, and the metrics, a few rows, checkpointed before
    they are released.
    """
    if exposure_offset:
        claims = claims.withColumn("_log_exposure", F.log(F.col(exposure_offset)))
    split = sampling.stratified_split(claims, key, binary_label, [train_fraction, 1 - train_fraction], seed=seed, exact=True)
    used = dict.fromkeys([count_label, binary_label, *numeric, *categorical, *(["_log_exposure"] if exposure_offset else [])])
    train = sampling.kfold(split.filter(F.col("split") == "train"), key, folds, seed=seed).select(*used, "fold")
    test = split.filter(F.col("split") == "test").select(*used)
    design = features.design_stages(numeric, categorical)
    specs = {
        "poisson": (
            models.poisson(count_label, offset="_log_exposure" if exposure_offset else None),
            RegressionEvaluator(labelCol=count_label, metricName="rmse"),
            False,
        ),
        "logistic_l1": (
            models.logistic(binary_label, penalty="l1"),
            BinaryClassificationEvaluator(labelCol=binary_label, numBins=0),
            True,
        ),
        "logistic_l2": (
            models.logistic(binary_label, penalty="l2"),
            BinaryClassificationEvaluator(labelCol=binary_label, numBins=0),
            True,
        ),
    }
    cv_rows, metric_rows, coef_rows, soft = [], [], [], []
    spark = claims.sparkSession
    with persisted(train) as cached, persisted(test) as held:
        for name, (est, ev, higher) in specs.items():
            pipe = Pipeline(stages=design + [est])
            grid = tuning.param_grid(est, {"regParam": list(reg_grid)})
            cvm = tuning.cross_validate(pipe, grid, ev, cached, folds=folds, fold_col="fold")
            cv_rows.append(tuning.cv_report(spark, cvm, grid, higher).withColumn("model", F.lit(name)))
            fitted = cvm.bestModel
            scored = fitted.transform(held)
            final = fitted.stages[-1]
            names = features.feature_names(scored, "features")
            coef_rows.append(models.coefficient_table(spark, final, names).withColumn("model", F.lit(name)))
            if name == "poisson":
                reg = metrics.regression_metrics(scored, count_label, "prediction")
                parts = [metrics.metric_long(reg, [], ["rmse"])]
            else:
                soft.append(models.positive_probability(scored).select(F.lit(name).alias("model"), binary_label, "p1"))
                parts = [metrics.metric_long(metrics.accuracy(scored, binary_label, "prediction"), [], ["accuracy"])]
            metric_rows += [p.select(F.lit(name).alias("model"), "metric", "value") for p in parts]
        # both classifiers at once
        auc = metrics.auc_by_group(metrics.metric_table(soft), ["model"], binary_label, "p1")
        metric_rows.append(metrics.metric_long(auc, ["model"], ["auc"]))
        scores = cut_lineage(metrics.metric_table(metric_rows))
    return {
        "cv": metrics.metric_table(cv_rows),
        "metrics": scores,
        "coefficients": metrics.metric_table(coef_rows),
    }


# --------------------------------------------------------------------- C6


def compare_classifiers(
    df: DataFrame,
    key: Sequence[str],
    label: str,
    feature_cols: Sequence[str],
    estimators: Mapping[str, tuple],
    sample_fraction: float = 0.01,
    test_fraction: float = 0.2,
    folds: int = 5,
    seed: int = 0,
) -> dict[str, DataFrame]:
    """Model selection on a stratified sample, refit on all training rows.

    ``estimators`` maps a name to (estimator on 'features', param axes).
    Reports ROC AUC of the positive-class probability (exact) and of the
    hard labels (balanced accuracy), which is what the reference printed.
    """
    spark = df.sparkSession
    split = sampling.hash_split(df, key, [1 - test_fraction, test_fraction], seed=seed)
    assembled = features.assemble(split, feature_cols, "features")
    train = assembled.filter(F.col("split") == "train")
    test = assembled.filter(F.col("split") == "test")
    # Equal keep-rates for every class: a plain hash sample keeps the class mix.
    train = train.select(*dict.fromkeys([*key, label, "features"]))
    sample = sampling.kfold(sampling.hash_sample(train, key, sample_fraction, seed=seed), key, folds, seed=seed).select(label, "features", "fold")
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="prediction", numBins=0)
    cv_rows, metric_rows, scores = [], [], []
    with persisted(train) as cached, persisted(sample) as chosen, persisted(test.select(label, "features")) as held:
        for name, (est, axes) in estimators.items():
            grid = tuning.param_grid(est, axes)
            cvm = tuning.cross_validate(est, grid, ev, chosen, folds=folds, fold_col="fold")
            cv_rows.append(tuning.cv_report(spark, cvm, grid).withColumn("model", F.lit(name)))
            model = tuning.refit_best(est, tuning.best_params(cvm, list(axes)), cached)
            scored = models.positive_probability(model.transform(held))
            scores.append(scored.select(F.lit(name).alias("model"), label, "p1"))
            hard = metrics.metric_long(metrics.balanced_accuracy(scored, label, "prediction"), [], ["balanced_accuracy"])
            metric_rows.append(hard.select(F.lit(name).alias("model"), "metric", "value"))
        # every model's AUC at once
        auc = metrics.auc_by_group(metrics.metric_table(scores), ["model"], label, "p1")
        metric_rows.append(metrics.metric_long(auc, ["model"], ["auc"]))
        table = cut_lineage(metrics.metric_table(metric_rows))
    return {"cv": metrics.metric_table(cv_rows), "metrics": table}


# ------------------------------------------------------------------ C7-C9


def recommender_report(
    ratings: DataFrame,
    movies: DataFrame,
    order_cols: Sequence[str] = ("timestamp", "userId", "movieId", "rating"),
    fractions: Sequence[float] = (0.4, 0.6, 0.8),
    settings: Mapping[str, Mapping] | None = None,
    cluster_setting: str | None = None,
    k: int = 25,
    seed: int = 0,
) -> dict[str, DataFrame]:
    """ALS over chronological splits, user clusters and cluster taste.

    Per split: metrics of every setting; k-means on the user factors of
    ``cluster_setting``; top clusters; top films and genres of the largest
    cluster (rated over all ratings, as in the reference).
    """
    settings = settings or {"setting1": {}, "setting2": {"regParam": 0.05}}
    cluster_setting = cluster_setting or list(settings)[-1]
    table, fitted = recommend.evaluate_over_splits(ratings, list(order_cols), fractions, settings, seed=seed)
    out: dict[str, DataFrame] = {"metrics": table}
    clusters_rows, movie_rows, genre_rows = [], [], []
    for f in fractions:
        factors = recommend.user_factor_vectors(fitted[(f, cluster_setting)])
        assigned = cut_lineage(clustering.kmeans_assign(factors, k=k, seed=seed).select("id", "prediction"))
        tag = F.lit(float(f)).alias("fraction")
        clusters_rows.append(recommend.top_clusters(assigned, 5).select(tag, "*"))
        taste = recommend.cluster_taste(ratings, assigned, movies)
        movie_rows.append(taste["top_movies"].select(tag, "*"))
        genre_rows.append(taste["top_genres"].select(tag, "*"))
    out["top_clusters"] = metrics.metric_table(clusters_rows)
    out["top_movies"] = metrics.metric_table(movie_rows)
    out["top_genres"] = metrics.metric_table(genre_rows)
    return out
