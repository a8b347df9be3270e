"""Opening files of a shared store in tasks, where Spark has no reader of the needed kind (byte ranges, appended records)."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Schemes as Hadoop names them -> as Arrow does.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}
_KNOWN = ("file", "hdfs", "viewfs", "s3", "gs", "gcs", "abfs")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Hadoop gives it: a path without one is of the cluster's default file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop.getFileSystem(conf).makeQualified(hadoop).toString()


def arrow_filesystem(uri: str):
    """(Arrow file system, path in it) of a qualified path; a store that Arrow cannot open is refused by name."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    scheme = _SCHEMES.get(scheme, scheme)
    if scheme not in _KNOWN:
        raise ValueError(f"no reader of byte ranges for {uri!r}: its scheme is not one of {', '.join(_KNOWN)}")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{scheme}:{rest}")
