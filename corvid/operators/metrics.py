"""Model metrics as one-row DataFrames (or grouped by setting).

All metrics are aggregates computed on the executors; nothing is pulled
to the driver.  ``group_by`` evaluates many models/splits in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.operators.prefix import running_sums
from corvid.operators.ranks import ordered, partition_of
from corvid.session import persisted


def regression_metrics(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", group_by: Sequence[str] = ()
) -> DataFrame:
    """(group..., n, rmse, mse, mae); rows with a NULL/NaN prediction are skipped."""
    err = F.col(prediction).cast("double") - F.col(label).cast("double")
    ok = pred.filter(F.col(prediction).isNotNull() & ~F.isnan(F.col(prediction).cast("double")))
    agg = ok.groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae")
    )
    return agg.select(*group_by, "n", F.sqrt("mse").alias("rmse"), "mse", "mae")


def regression_metric(pred: DataFrame, metric: str, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One named metric ('rmse', 'mse' or 'mae') as (metric, value): the per-call override."""
    if metric not in ("rmse", "mse", "mae"):
        raise ValueError(f"unknown regression metric {metric!r}")
    m = regression_metrics(pred, label, prediction)
    return m.select(F.lit(metric).alias("metric"), F.col(metric).alias("value"))


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction", group_by: Sequence[str] = ()) -> DataFrame:
    """(group..., n, accuracy)."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return pred.groupBy(*group_by).agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def confusion_rates(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(tp, fp, tn, fn) in one aggregate."""
    y = F.col(label).cast("double") == 1.0
    p = F.col(prediction).cast("double") == 1.0
    return pred.agg(
        F.sum((y & p).cast("long")).alias("tp"),
        F.sum((~y & p).cast("long")).alias("fp"),
        F.sum((~y & ~p).cast("long")).alias("tn"),
        F.sum((y & ~p).cast("long")).alias("fn"),
    )


def balanced_accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(TPR + TNR) / 2, which is what ROC AUC of hard 0/1 predictions equals."""
    c = confusion_rates(pred, label, prediction)
    return c.select(
        "tp", "fp", "tn", "fn",
        # NULL when a class is missing
        (
            0.5
            * (F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")) + F.try_divide(F.col("tn"), F.col("tn") + F.col("fp")))
        ).alias("balanced_accuracy"),
    )


def auc_exact(pred: DataFrame, label: str = "label", score: str = "score", buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC with ties counted as one half (Mann-Whitney), one row.

    Scores are aggregated to (score, positives, negatives) first, so the
    sorted pass runs over distinct scores; the running count of negatives
    below each score comes from :func:`running_sums` (no single-task sort),
    whatever the number of scores.  A NULL score ranks below every other and
    a NaN above (each a tie group of its own); rows with a NULL label count
    as neither class; with one class only the AUC is NULL.
    The per-score table is cached for the passes of the computation only,
    and the bounded one-row result is returned.
    """
    y = F.col(label).cast("double") == 1.0
    by_score = pred.groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")
    )
    spark = pred.sparkSession
    with persisted(by_score) as cached:
        cum = running_sums(cached, "_s", ["neg"], buckets=buckets)
        # doubles: the product of two counts may pass the range of a long
        area = F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg")))
        row = cum.agg(
            F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"),
            F.sum("pos").alias("positives"),
            F.sum("neg").alias("negatives"),
        ).first()
    return spark.createDataFrame(
        [(row["auc"], row["positives"], row["negatives"])], "auc double, positives bigint, negatives bigint"
    )


def auc_by_group(pred: DataFrame, group_by: Sequence[str], label: str = "label", score: str = "score") -> DataFrame:
    """(group..., auc, positives, negatives): exact ROC AUC of every group (model, fold ...) at once.

    Segmented prefix sums: the distinct (group, score) rows are put in order
    over the whole cluster by range, so a group of many scores lies in many
    partitions; a row's negatives below it are those of its group in earlier
    partitions (a row a group and partition) plus those before it in its own.
    Copies of a score are one row before the shuffle.  Ties, NULL and NaN
    scores, NULL labels and one-class groups are as in :func:`auc_exact`; a
    NULL group is a group.
    """
    group_by = list(group_by)
    y = F.col(label).cast("double") == 1.0
    by_score = pred.groupBy(*group_by, F.col(score).cast("double").alias("_s")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    rows = ordered(by_score, [*(F.col(c).asc_nulls_first() for c in group_by), F.col("_s").asc_nulls_first()]).withColumn("_part", partition_of())
    per_part = rows.groupBy(*group_by, "_part").agg(F.sum("neg").alias("_n"))
    earlier = Window.partitionBy(*group_by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(*(F.col(c).alias(f"_g_{c}") for c in group_by), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    own = F.col("_part") == F.col("_p")
    for c in group_by:
        own = own & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    inside = Window.partitionBy(*group_by, "_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    below = rows.withColumn("_in", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(offsets, own)
    # doubles: the product of two counts may pass the range of a long
    area = F.sum(F.col("pos") * (F.col("_off") + F.col("_in") + 0.5 * F.col("neg")))
    return below.groupBy(*group_by).agg(
        F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )


def auc_mllib(pred: DataFrame, label: str = "label", raw: str = "rawPrediction", num_bins: int = 0) -> float:
    """MLlib's evaluator (``numBins=0`` = exact; the default 1000 is approximate)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC", numBins=num_bins)
    return ev.evaluate(pred)


def metric_table(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack one-row metric frames (same columns) into a report table."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def metric_long(report: DataFrame, id_cols: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide metric table -> (id..., metric, value)."""
    return report.unpivot(list(id_cols), list(metrics), "metric", "value")
