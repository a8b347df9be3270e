"""Scans with explicit schemas.

Schema inference costs an extra pass over the input, so every CSV source
here takes a ``StructType``.  Gzip text is not splittable: one task per
file, so callers reading a few large ``.gz`` files should pass
``min_partitions`` to spread the parse (and everything after it) out, or
index them once (:mod:`corvid.sources.gzip_index`) and read them in ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: columns of the public dataset.
PARTICLE_FEATURES = [f"feature{i}" for i in range(1, 29)]

PARTICLES_SCHEMA = T.StructType(
    [T.StructField("label", T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in PARTICLE_FEATURES]
)

RATINGS_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("movieId", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

MOVIES_SCHEMA = T.StructType(
    [
        T.StructField("movieId", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ]
)


def read_text_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One ``value`` string per line (gzip handled by the codec).

    ``min_partitions`` deals the lines anew after a scan of fewer files: a
    gzip file is one task, and the narrow parse after it would stay there.
    """
    df = spark.read.text(path)
    return df.repartition(min_partitions) if min_partitions and len(df.inputFiles()) < min_partitions else df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = False,
    **options,
) -> DataFrame:
    """CSV scan with a fixed schema (no inference pass)."""
    reader = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_headerless_csv(spark: SparkSession, path: str, names: list[str], types: list[T.DataType] | None = None) -> DataFrame:
    """Headerless CSV with positional names (``toDF(*names)`` done via the schema)."""
    types = types or [T.DoubleType()] * len(names)
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])
    return read_csv(spark, path, schema, header=False)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = False,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects): a CSV scan that loses no malformed field.

    A plain scan turns a field that does not fit its type into NULL, unseen.
    Here every field is read as text and cast by itself.  A row is good if it
    has as many fields as the schema and each field is empty or fits its
    type.  Rejects are (file, line, reason): the text of the row, and
    ``fields`` (too few or too many) or the first column that does not fit.
    Both come from one scan each; empty fields are NULL, as in a plain scan.
    """
    line = "_line"
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(line, T.StringType())])
    reader = spark.read.schema(text).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", line)
    for k, v in options.items():
        reader = reader.option(k, v)
    raw = reader.csv(path)
    fits = {f.name: F.col(f.name) if isinstance(f.dataType, T.StringType) else F.trim(f.name).try_cast(f.dataType) for f in schema.fields}
    reason = F.when(F.col(line).isNotNull(), F.lit("fields"))
    for name, cast in fits.items():
        reason = reason.when(F.col(name).isNotNull() & cast.isNull(), F.lit(name))
    marked = raw.select("*", reason.alias("_reason"), F.input_file_name().alias("_file"))
    good = marked.where("_reason is null").select(*(cast.alias(name) for name, cast in fits.items()))
    # the row's text is there if the number of fields is wrong; else it is put together from its fields
    own = F.coalesce(F.col(line), F.concat_ws(options.get("sep", ","), *(F.coalesce(F.col(f.name), F.lit("")) for f in schema.fields)))
    rejects = marked.where("_reason is not null").select(F.col("_file").alias("file"), own.alias("line"), F.col("_reason").alias("reason"))
    return good, rejects
