"""Grid search with k-fold cross-validation, best-parameter reports, refit.

Folds come from a hash of the row key (``foldCol``), so they are stable
across retries and partitionings; the training frame is persisted once
for all fits, the folds are filters on it, and ``parallelism`` fits
several settings at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from corvid.session import persisted


def param_grid(est: Estimator, axes: Mapping[str, Sequence]) -> list[dict]:
    """Cartesian grid over named params of ``est``."""
    b = ParamGridBuilder()
    for name, values in axes.items():
        b = b.addGrid(est.getParam(name), list(values))
    return b.build()


def cross_validate(
    est: Estimator,
    grid: list[dict],
    evaluator,
    train: DataFrame,
    folds: int = 5,
    fold_col: str | None = None,
    seed: int | None = None,
    parallelism: int | None = None,
    partitions: int | None = None,
) -> CrossValidatorModel:
    """k-fold CV; with ``fold_col`` the folds are the given (hash) folds.

    ``parallelism`` (default: up to 4, capped by the grid size) runs that
    many fits as concurrent Spark jobs; ``partitions`` deals the training
    rows anew first.  No job runs before the fit.  Given folds are filters
    on the one persisted frame: ``CrossValidator`` would keep a copy of
    every fold's training and validation rows beside it.
    """
    parallelism = parallelism or max(1, min(4, len(grid)))
    with persisted(train.repartition(partitions) if partitions else train) as cached:
        if fold_col:
            return _cross_validate_folds(est, grid, evaluator, cached, folds, fold_col, parallelism)
        cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, parallelism=parallelism)
        return (cv if seed is None else cv.setSeed(seed)).fit(cached)


def _cross_validate_folds(est: Estimator, grid: list[dict], evaluator, rows: DataFrame, folds: int, fold_col: str, parallelism: int) -> CrossValidatorModel:
    """What ``CrossValidator`` does with a fold column, without copies of the rows."""
    fold = F.col(fold_col)
    known = F.when(fold.between(0, folds - 1), fold).alias("_fold")
    sizes = {r["_fold"]: r["count"] for r in rows.groupBy(known).count().collect()}  # folds + 1 rows at most
    if None in sizes:
        raise ValueError(f"Fold number must be in range [0, {folds})")
    for i in range(folds):
        if len(sizes.keys() - {i}) == 0:
            raise ValueError(f"The training data at fold {i} is empty.")
        if i not in sizes:
            raise ValueError(f"The validation data at fold {i} is empty.")

    def score(task):
        i, params = task
        model = est.fit(rows.filter(fold != i), params)
        return evaluator.evaluate(model.transform(rows.filter(fold == i), params))

    tasks = [(i, params) for i in range(folds) for params in grid]
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        scores = pool.map(inheritable_thread_target(rows.sparkSession)(score), tasks, chunksize=1)
    table = np.array(scores).reshape(folds, len(grid))
    means = table.mean(axis=0)
    best = int(means.argmax() if evaluator.isLargerBetter() else means.argmin())
    return CrossValidatorModel(est.fit(rows, grid[best]), means.tolist(), None, table.std(axis=0).tolist())


def _final_stage(model):
    stages = getattr(model, "stages", None)
    return stages[-1] if stages else model


def cv_report(spark: SparkSession, cv_model: CrossValidatorModel, grid: list[dict], higher_is_better: bool = True) -> DataFrame:
    """(setting, param, value, avg_metric, std_metric, is_best) — one row per setting and param."""
    avgs = list(cv_model.avgMetrics)
    stds = list(getattr(cv_model, "stdMetrics", []) or [float("nan")] * len(avgs))
    best = max(range(len(avgs)), key=lambda i: avgs[i]) if higher_is_better else min(range(len(avgs)), key=lambda i: avgs[i])
    rows = []
    for i, pm in enumerate(grid):
        for p, v in sorted(pm.items(), key=lambda kv: kv[0].name):
            rows.append((i, p.name, str(v), float(avgs[i]), float(stds[i]), i == best))
    schema = T.StructType(
        [
            T.StructField("setting", T.IntegerType()),
            T.StructField("param", T.StringType()),
            T.StructField("value", T.StringType()),
            T.StructField("avg_metric", T.DoubleType()),
            T.StructField("std_metric", T.DoubleType()),
            T.StructField("is_best", T.BooleanType()),
        ]
    )
    return spark.createDataFrame(rows, schema)


def best_params(cv_model: CrossValidatorModel, names: Sequence[str]) -> dict:
    """Chosen values of ``names`` from the best model's public param map."""
    final = _final_stage(cv_model.bestModel)
    out = {}
    for n in names:
        if final.hasParam(n):
            out[n] = final.getOrDefault(final.getParam(n))
    return out


def refit_best(est: Estimator, params: Mapping, train: DataFrame):
    """Fit a copy of ``est`` with the chosen params on all training rows."""
    pm = {est.getParam(k): v for k, v in params.items()}
    return est.copy(pm).fit(train)
