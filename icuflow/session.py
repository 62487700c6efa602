"""Session factory (S8), persistence helpers (S9) and reliable checkpoints."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  AQE gives runtime re-planning: it turns a
# sort-merge join into a broadcast join only when the measured size of a side
# is under the threshold (a size-checked broadcast with a fallback), splits
# skewed join partitions and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where an aggregation after it then needs another exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # At scale set spark.sql.shuffle.partitions to about (largest shuffle
    # bytes / 128 MB) and let AQE merge small partitions; on a busy shared
    # cluster also consider coalescePartitions.parallelismFirst=false so that
    # merging targets the advisory size rather than one partition per core.
    "spark.checkpoint.compress": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files of ordered scans are deleted once their DataFrame is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def create_session(app_name: str = "icuflow", master: str | None = None,
                   conf: dict[str, str] | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or get) a session with the library defaults."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    extra = dict(conf or {})
    if shuffle_partitions:
        extra["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in {**DEFAULT_CONF, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_persisted: list[DataFrame] = []


def persist(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Persist a DataFrame that is reused by several actions.

    A result that reads it lazily outlives the function that made it; ``release_persisted`` frees the
    copies once the results are used.
    """
    copy = df.persist(level)
    _persisted.append(copy)
    return copy


def release_persisted() -> int:
    """Free every copy made by ``persist`` and not yet freed; results that still need one compute it anew."""
    freed = 0
    while _persisted:
        copy = _persisted.pop()
        if copy.storageLevel != StorageLevel.NONE:
            copy.unpersist()
            freed += 1
    return freed


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """``df`` persisted for the actions of the block and released after it.

    A DataFrame derived from it and returned still works: it is computed anew, without the copy.
    """
    copy = df.persist(level)
    try:
        yield copy
    finally:
        copy.unpersist()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and stage files.

    Taken from the running context or ``spark.checkpoint.dir``.  Only a
    local-mode session without either gets a folder of its own (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
        # A folder of this application on the session's default file system, deleted at its end.
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        fs = jvm.org.apache.hadoop.fs.FileSystem.get(conf)
        path = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"/tmp/icuflow-{sc.applicationId}"))
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        configured = path.toString()
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Survives executor loss (unlike a local checkpoint), and pins the exact
    partitioning so that several jobs see the same partitions.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder written by ``scratch_path`` users, on whatever file system it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover - conf always present
        return max(os.cpu_count() or 8, 8)
