"""Session helpers.

The library never sets the master or starts a session of its own inside an
operator: callers own the session. These helpers only (a) build a local
session for tests and the bench, and (b) find the shared folder the cluster
names in ``spark.checkpoint.dir`` for lineage cuts and scratch tables.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "spindle") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder. A temporary one is set only for
    a master in one process (``local``, ``local[N]``: tests, local runs); on a
    cluster a folder of one machine would lose data, so there the setting must
    name a folder that all machines share."""
    path = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set: on {master} it must name a shared folder")
        path = tempfile.mkdtemp(prefix="spindle-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


#: Bytes of input for each partition that an aggregate starts with.
BYTES_PER_PARTITION = 64 << 20
WIDTH_CONF = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files under a plan, from its statistics: nothing runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


@contextmanager
def shuffle_width(df: DataFrame, bytes_per_partition: int = BYTES_PER_PARTITION):
    """While ``df`` runs, its shuffles start with as many partitions as its input
    calls for, if these are more than ``spark.sql.shuffle.partitions``; adaptive
    execution merges what turns out small, but never widens."""
    spark = df.sparkSession
    width = -(-input_bytes(df) // bytes_per_partition)
    old = spark.conf.get(WIDTH_CONF, None)
    most = max(width, int(spark.conf.get("spark.sql.shuffle.partitions")), int(old or 0))
    spark.conf.set(WIDTH_CONF, str(min(most, 1 << 20)))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(WIDTH_CONF)
        else:
            spark.conf.set(WIDTH_CONF, old)


#: Shuffle files of a write go when it is done, not when the driver's next garbage collection finds them.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """While it lasts, jobs that write a table leave no shuffle files behind."""
    old = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, old)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root.rstrip("/"), f"{name}-{uuid.uuid4().hex[:12]}")


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables of a finished job (paths of :func:`scratch_path`)."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
