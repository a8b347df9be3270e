"""k-means on feature vectors and naming clusters stably."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_vector(df: DataFrame, cols: list[str] | str, out_col: str = "features") -> DataFrame:
    """Numeric columns or an array column -> ML vector column."""
    if isinstance(cols, str) and not df.schema[cols].dataType.simpleString().startswith("array"):
        cols = [cols]
    if isinstance(cols, str):
        return df.withColumn(out_col, array_to_vector(F.col(cols).cast("array<double>")))
    return VectorAssembler(inputCols=list(cols), outputCol=out_col).transform(df)


def kmeans_assign(
    df: DataFrame, k: int, seed: int | None = None, features: str = "features", out_col: str = "prediction", **params
) -> DataFrame:
    """Fit k-means and assign every row to a cluster."""
    est = KMeans(k=k, featuresCol=features, predictionCol=out_col, **params)
    if seed is not None:
        est = est.setSeed(seed)
    model = est.fit(df)
    return model.transform(df)


def name_by_smallest_member(assigned: DataFrame, id_col: str, cluster_col: str = "prediction", out_col: str = "cluster") -> DataFrame:
    """Replace arbitrary cluster numbers by the smallest member id.

    The per-cluster minimum is an aggregate (one row per cluster), joined
    back; numbering does not depend on the k-means initialisation.
    """
    names = assigned.groupBy(cluster_col).agg(F.min(id_col).alias(out_col))
    return assigned.join(names, cluster_col)

