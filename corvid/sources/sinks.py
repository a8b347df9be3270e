"""Result delivery: report tables instead of prints, charts and pandas frames."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_report(df: DataFrame) -> DataFrame:
    """``printSchema`` as a table (position, name, type, nullable)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType(
        [
            T.StructField("position", T.IntegerType(), False),
            T.StructField("name", T.StringType(), False),
            T.StructField("type", T.StringType(), False),
            T.StructField("nullable", T.BooleanType(), False),
        ]
    )
    return df.sparkSession.createDataFrame(rows, schema)


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partitions: int | None = 1) -> str:
    """Write a (small) report table; ``partitions=None`` keeps Spark's layout."""
    out = df.coalesce(partitions) if partitions else df
    writer = out.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """``show(n)`` as a DataFrame: the first n rows in the existing order."""
    return df.limit(n)


# ----------------------------------------------------------- ordered export


def write_ordered(df: DataFrame, path: str, order: Sequence[Column | str], files: int | None = None, fmt: str = "parquet") -> str:
    """Write ``df`` so that its files, by name, and the rows in them are in order.

    Rows are dealt by range of the order columns and a random last column, so
    that a key on a third of all rows fills several files, each in order,
    instead of one.  ``files`` is the number of ranges (Spark's number of
    shuffle partitions if not given); an empty range leaves no file.
    """
    by = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    salted = df.withColumn("_salt", F.rand(11))
    dealt = salted.repartitionByRange(files, *by, F.col("_salt")) if files else salted.repartitionByRange(*by, F.col("_salt"))
    dealt.sortWithinPartitions(*by).drop("_salt").write.format(fmt).save(path)
    return path


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`write_ordered` (Parquet) plus ``position``: 0, 1, 2 ... through files and rows."""
    rows = spark.read.parquet(path)
    own = rows.columns
    rows = rows.select(*own, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    # a row a file
    offsets = counts.select("_file", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(offsets, "_file").select(*own, (F.col("_before") + F.col("_row")).alias("position"))


# -------------------------------------------------------- committed reports

_MANIFEST = "_current"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish(reports: Mapping[str, DataFrame], path: str, fmt: str = "parquet", keep: int = 2) -> str:
    """Write all reports to a fresh snapshot, then make it the current one; returns the snapshot's name.

    Readers follow the manifest ``_current``, which is replaced by a rename
    after every report is written whole.  A job that fails before, or a lost
    driver, leaves the former snapshot current and its own folder unread; a
    rerun writes another.  The ``keep`` newest published snapshots stay for
    readers that are under way; unpublished and older ones are removed.
    """
    if not reports:
        raise ValueError("no reports to publish")
    spark = next(iter(reports.values())).sparkSession
    path = path.rstrip("/")
    started = time.time()
    name = f"{int(started * 1000):015d}-{uuid.uuid4().hex[:8]}"
    for report, df in reports.items():
        df.write.format(fmt).save(f"{path}/snapshots/{name}/{report}")
    former = _manifest(spark, path)
    history = [name, *former.get("published", [])][:keep]
    manifest = json.dumps({"snapshot": name, "format": fmt, "reports": sorted(reports), "published": history})
    jvm, draft, fs = _hadoop(spark, f"{path}/.manifest-{name}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(manifest.encode()))
        out.hsync()
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(draft, jvm.org.apache.hadoop.fs.Path(f"{path}/{_MANIFEST}"), overwrite)
    for old in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/snapshots")):
        own = old.getPath().getName()
        # a snapshot that began later belongs to another writer
        if own not in history and own < name:
            fs.delete(old.getPath(), True)
    return name


def _manifest(spark: SparkSession, path: str) -> dict:
    jvm, at, fs = _hadoop(spark, f"{path}/{_MANIFEST}")
    if not fs.exists(at):
        return {}
    stream = fs.open(at)
    try:
        return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def read_published(spark: SparkSession, path: str, report: str) -> DataFrame:
    """A report of the current snapshot."""
    path = path.rstrip("/")
    manifest = _manifest(spark, path)
    if report not in manifest.get("reports", []):
        raise ValueError(f"{path} has no published report {report!r}")
    return spark.read.format(manifest["format"]).load(f"{path}/snapshots/{manifest['snapshot']}/{report}")
