"""Feature pipelines: assemble, scale, index, one-hot.

Thin, parameterised builders over MLlib stages.  Fitting a stage runs a
distributed aggregate (means and variances, category counts); applying it
is a narrow projection.  ``vector_columns`` turns a vector into plain
columns for reports and SQL checks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assembler(input_cols: Sequence[str], output_col: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(input_cols), outputCol=output_col, handleInvalid=handle_invalid)


def assemble(df: DataFrame, input_cols: Sequence[str], output_col: str = "features") -> DataFrame:
    """Columns -> one vector column."""
    return assembler(input_cols, output_col).transform(df)


def scaler(input_col: str, output_col: str, with_mean: bool = True, with_std: bool = True) -> StandardScaler:
    """z-score (sample standard deviation) or scale by sd only."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=with_mean, withStd=with_std)


def indexer(cols: Sequence[str], handle_invalid: str = "keep", suffix: str = "_index", order: str = "frequencyDesc") -> StringIndexer:
    """Category -> index (most frequent = 0, ties alphabetical); ``keep`` maps unseen to an extra index."""
    return StringIndexer(
        inputCols=list(cols),
        outputCols=[c + suffix for c in cols],
        handleInvalid=handle_invalid,
        stringOrderType=order,
    )


def one_hot(cols: Sequence[str], in_suffix: str = "_index", out_suffix: str = "_onehot", drop_last: bool = True) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[c + in_suffix for c in cols], outputCols=[c + out_suffix for c in cols], dropLast=drop_last
    )


def design_stages(
    numeric: Sequence[str],
    categorical: Sequence[str],
    scale: bool = True,
    encode: str = "onehot",
    handle_invalid: str = "keep",
    output_col: str = "features",
) -> list:
    """Stages: numeric -> (scaled) vector; categories -> index -> one-hot (or ordinal codes); all -> features.

    ``encode='ordinal'`` feeds the index codes directly (draft variant).
    """
    stages: list = []
    parts: list[str] = []
    if numeric:
        stages.append(assembler(numeric, "num_features"))
        if scale:
            stages.append(scaler("num_features", "scaled_features"))
            parts.append("scaled_features")
        else:
            parts.append("num_features")
    if categorical:
        stages.append(indexer(categorical, handle_invalid))
        if encode == "onehot":
            stages.append(one_hot(categorical))
            parts += [c + "_onehot" for c in categorical]
        elif encode == "ordinal":
            parts += [c + "_index" for c in categorical]
        else:
            raise ValueError("encode must be 'onehot' or 'ordinal'")
    stages.append(assembler(parts, output_col))
    return stages


def feature_pipeline(numeric: Sequence[str], categorical: Sequence[str], **kw) -> Pipeline:
    return Pipeline(stages=design_stages(numeric, categorical, **kw))


def fit_transform(pipeline: Pipeline, train: DataFrame, *others: DataFrame) -> tuple[PipelineModel, list[DataFrame]]:
    """Fit on ``train`` only, apply to it and to the other frames."""
    model = pipeline.fit(train)
    return model, [model.transform(d) for d in (train, *others)]


def vector_columns(df: DataFrame, vec_col: str, width: int, prefix: str = "f", digits: int | None = 6) -> list:
    """Column expressions f0..f{width-1} for the vector's entries (rounded)."""
    arr = vector_to_array(F.col(vec_col))
    cols = []
    for i in range(width):
        c = arr.getItem(i)
        if digits is not None:
            c = F.round(c, digits) + F.lit(0.0)
        cols.append(c.alias(f"{prefix}{i}"))
    return cols


def vector_width(df: DataFrame, vec_col: str) -> int:
    """Width from the column's ML attribute metadata (no data pass)."""
    meta = df.schema[vec_col].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    attrs = meta.get("attrs", {})
    return sum(len(v) for v in attrs.values())


def feature_names(df: DataFrame, vec_col: str) -> list[str]:
    """Slot names from the vector's attribute metadata, in slot order."""
    attrs = df.schema[vec_col].metadata.get("ml_attr", {}).get("attrs", {})
    slots = [(a["idx"], a.get("name", f"x{a['idx']}")) for group in attrs.values() for a in group]
    return [name for _, name in sorted(slots)]
