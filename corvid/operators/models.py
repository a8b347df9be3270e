"""Estimators, scoring and coefficient reports.

The solvers are MLlib's own (distributed gradient / IRLS aggregates, tree
histograms).  This module fixes the defaults the jobs need, pulls the
positive-class probability out as a plain column, and reports model
parameters as DataFrames instead of prints.
"""

from __future__ import annotations

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def poisson(label: str, features: str = "features", offset: str | None = None, **params) -> GeneralizedLinearRegression:
    """Poisson GLM with log link; ``offset`` e.g. a log-exposure column."""
    est = GeneralizedLinearRegression(family="poisson", link="log", labelCol=label, featuresCol=features, **params)
    if offset:
        est = est.setOffsetCol(offset)
    return est


def logistic(label: str, features: str = "features", penalty: str | None = None, weight: str | None = None, **params) -> LogisticRegression:
    """Binomial logistic regression; ``penalty`` 'l1' or 'l2' sets elasticNetParam."""
    if penalty == "l1":
        params.setdefault("elasticNetParam", 1.0)
    elif penalty == "l2":
        params.setdefault("elasticNetParam", 0.0)
    est = LogisticRegression(labelCol=label, featuresCol=features, family="binomial", **params)
    if weight:
        est = est.setWeightCol(weight)
    return est


def random_forest(label: str, features: str = "features", **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol=features, **params)


def gbt(label: str, features: str = "features", **params) -> GBTClassifier:
    return GBTClassifier(labelCol=label, featuresCol=features, **params)


def decision_tree(label: str, features: str = "features", **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, **params)


def mlp(label: str, layers: list[int], features: str = "features", **params) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, layers=list(layers), **params)


def positive_probability(pred: DataFrame, prob_col: str = "probability", out_col: str = "p1") -> DataFrame:
    """Adds P(class 1) as a double column."""
    return pred.withColumn(out_col, vector_to_array(F.col(prob_col)).getItem(1))


def coefficient_table(spark: SparkSession, model, names: list[str], intercept_name: str = "(intercept)") -> DataFrame:
    """(position, term, coefficient) for a linear model, intercept first (-1).

    The coefficients are model parameters, one per feature slot (bounded by
    the design width, not by the data).
    """
    coefs = model.coefficients.toArray().tolist()
    if len(names) != len(coefs):
        names = [f"x{i}" for i in range(len(coefs))]
    rows = [(-1, intercept_name, float(model.intercept))] + [(i, n, float(c)) for i, (n, c) in enumerate(zip(names, coefs))]
    schema = T.StructType(
        [
            T.StructField("position", T.IntegerType(), False),
            T.StructField("term", T.StringType(), False),
            T.StructField("coefficient", T.DoubleType(), False),
        ]
    )
    return spark.createDataFrame(rows, schema)
