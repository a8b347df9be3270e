"""Shared helpers: scratch tables, bounded Arrow batches, components of a graph."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.session import scratch_path
from corvid.sources import readers

#: Bytes of one Arrow batch between Spark and Python, so that long texts
#: make batches of fewer rows.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by bytes as well as by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def give_back() -> None:
    """Give the memory that this process has free, but keeps for later use, back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def giving_back(work: Callable) -> Callable:
    """``work`` on a task's batches, whose worker gives free memory back after each batch and at the end.

    Spark keeps idle workers and uses them in turn, so what each of them
    has kept from earlier stages counts with every later stage.
    """

    @wraps(work)
    def run(batches):
        def each():
            for batch in batches:
                yield batch
                give_back()

        try:
            yield from work(each())
        finally:
            give_back()

    return run


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return readers.read_table(spark, sf_dir, name)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared scratch folder, removed when the session's JVM ends."""
    path = scratch_path(spark, name)
    if _scopes:
        _scopes[-1].append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the scratch folders made inside the block when it ends; those taken out of the list stay.

    For tables whose last reader is a table that was written in the block.
    """
    _scopes.append([])
    try:
        yield _scopes[-1]
    finally:
        for path in _scopes.pop():
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


#: Rows that a task writes at least, where their number is known, and the fewest tasks.
ROWS_A_TASK, FEWEST_TASKS = 250_000, 8


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation,
    and both sides of a later join are plain exchanges that adaptive
    execution can split when a key is hot.  ``rows``, a bound of the rows,
    keeps small tables from a file for every shuffle partition.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    if rows is not None:
        df = df.coalesce(max(FEWEST_TASKS, -(-rows // ROWS_A_TASK)))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """Hash of a text, which with its doc_id names a row; equal rows share it."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def slices(texts: list[bytes] | list[str], most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Index ranges of at most ``most`` bytes (or characters) together, one text at least."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts after each other, with each text's start and length."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]]) if len(texts) else np.zeros(0, np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), starts, lens


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """All of start..start+len-1 for each pair, concatenated."""
    lens = np.asarray(lens, np.int64)
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.repeat(np.asarray(starts, np.int64) - (ends - lens), lens) + np.arange(total)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "cc", rows: int | None = None) -> DataFrame:
    """(node, component) for every node of an undirected edge table of longs.

    The component is the smallest node reachable.  Each round takes the
    smallest label among the neighbours and then the label's own label
    (pointer jumping), in written tables; rounds end when no label changes.
    Rows with a null end and loops are ignored.  ``rows`` may bound the edges.
    """
    pairs = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    pairs = written(pairs, f"{name}-edges", rows)
    both = pairs.union(pairs.select("b", "a"))
    n = 2 * pairs.count()  # nodes at most
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), f"{name}-0", n)
    for step in range(1, 200):
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m"))
        low = written(labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "m").alias("c")), f"{name}-{step}a", n)
        parent = low.select(F.col("node").alias("c"), F.col("c").alias("up"))
        labels = written(low.join(parent, "c", "left").select("node", F.coalesce("up", "c").alias("component"), "old"), f"{name}-{step}b", n)
        if labels.where("component <> old").isEmpty():
            break
        labels = labels.drop("old")
    else:
        raise RuntimeError("connected components did not converge in 200 rounds")
    return labels.select("node", "component")
