"""Session-level helpers: shared scratch space and lineage cuts.

The library never builds a SparkSession and never sets a master.  Scratch
files (checkpoints, text/CSV renderings used by the scan operators) live
under the shared folder the cluster names in ``spark.checkpoint.dir``.  On
a cluster that setting is required; only a local master, where driver and
executors are one process, may do without it.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for scratch data; a local master without one gets a temporary folder."""
    opt = spark.sparkContext._jsc.sc().getCheckpointDir()
    ctx_dir = opt.get() if opt.isDefined() else None
    root = spark.conf.get(_CHECKPOINT_KEY, None) or ctx_dir
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="corvid-ckpt-")
        try:
            spark.conf.set(_CHECKPOINT_KEY, root)
        except Exception:  # noqa: BLE001 - core settings may be read-only at runtime
            pass
    if not ctx_dir:
        # The setting may have been given after the context started.
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared scratch folder, removed when the session's JVM ends."""
    path = f"{checkpoint_root(spark).rstrip('/')}/corvid-{name}-{uuid.uuid4().hex[:12]}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike ``localCheckpoint``) and pins any
    nondeterministic upstream stage (sampling, range bounds) to one result.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def free_shuffles(df: DataFrame) -> None:
    """Delete the shuffle files that ``df`` has left after :func:`cut_lineage`, up to what is persisted below it.

    Otherwise they stay until the driver happens to collect its garbage.
    """
    df._jdf.queryExecution().executedPlan().execute().cleanShuffleDependencies(False)


#: A partition of a dealt scan stands for at most this many bytes of files.
PART_BYTES = 16 << 20


def _file_bytes(spark: SparkSession, files: list[str]) -> int:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f) for f in files]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def spread_scan(scan: DataFrame) -> DataFrame:
    """A bare file scan, dealt anew if it has fewer files than the partitions it should have.

    A single-file table (one parquet row group, one gzip file) is scanned
    by one task, and every narrow step after it (parsing, model training)
    stays in that task.  It is dealt to a partition for each core, and to
    more if one would stand for more than ``PART_BYTES`` of files, so that
    what a task reads or caches does not grow with the table.  A table of
    many files is left as it is.  Files are counted from the listing and
    their sizes looked up, so no job runs.  The repartition is round-robin
    after a local sort, so retries see the same rows in the same partitions.
    """
    spark, files = scan.sparkSession, scan.inputFiles()
    target = max(spark.sparkContext.defaultParallelism, -(-_file_bytes(spark, files) // PART_BYTES))
    return scan.repartition(target) if len(files) < target else scan


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Cache ``df`` for the multi-pass work inside the block (model fits), then release it.

    A frame that its caller has cached stays cached.
    """
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        yield df
        return
    cached = df.persist(level)
    try:
        yield cached
    finally:
        cached.unpersist()
