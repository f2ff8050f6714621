"""Session helpers: one place for the settings every job here relies on."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, partitions: int | None = None,
                  app: str = "linkgraph") -> SparkSession:
    """A session for tests, the bench and scripts.

    On a cluster, pass nothing: master, parallelism and ``spark.checkpoint.dir``
    come from the cluster's own configuration.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         # Round checkpoints nobody refers to any more are removed, not kept.
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         # The link extractor ships whole pages through Arrow; keep batches
         # small enough that one batch of large pages stays well inside memory.
         .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2048"))
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or a directory already set
    on the context). Only a local-mode session without one gets a private
    scratch folder; a cluster session without one is a configuration error,
    as a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        configured = tempfile.mkdtemp(prefix="linkgraph-ck-")
    sc.setCheckpointDir(configured)
    # setCheckpointDir adds a per-application sub-folder; our written tables
    # go into it too, next to the RDD checkpoints.
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh path under the checkpoint root for one written table."""
    return os.path.join(checkpoint_root(spark), f"{kind}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, kind: str, path: str | None = None) -> tuple[DataFrame, str]:
    """``df`` written once as parquet under the checkpoint root (or at ``path``)
    and read back, with its path: columns are pruned on reading, and a lost
    executor costs nothing that is written. :func:`remove_path` deletes it."""
    path = path or scratch_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table this library wrote, on whatever file system it lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]):
    """Session settings that hold within the block, for what is written there; what was set before is restored."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Rows per shuffle partition the rank jobs aim for before adaptive coalescing.
ROWS_PER_SHUFFLE_PARTITION = 2 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def sized_shuffles(spark: SparkSession, rows: int):
    """Let exchanges of a job over ``rows`` rows start with enough partitions.

    Adaptive execution merges small shuffle partitions but never splits an
    aggregation's large ones, so the initial count must not be too low for the
    data. Within the block, the initial partition number is raised to
    ``rows / ROWS_PER_SHUFFLE_PARTITION`` when the session's own setting is
    lower; it is never lowered, and the session's value is restored after.
    """
    want = math.ceil(rows / ROWS_PER_SHUFFLE_PARTITION)
    current = spark.conf.get(_INITIAL, None)
    base = int(current) if current else int(spark.conf.get("spark.sql.shuffle.partitions"))
    if want <= base:
        yield
        return
    spark.conf.set(_INITIAL, str(want))
    try:
        yield
    finally:
        if current is None:
            spark.conf.unset(_INITIAL)
        else:
            spark.conf.set(_INITIAL, current)
