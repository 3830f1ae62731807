"""Session helpers.

Library code never hard-codes a shuffle width or a scratch location: it
reads what the cluster configured.  Only local/test sessions get defaults.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


#: Rows of a shuffle partition: whole orders of this many rows are sorted in about 100 MB.
ROWS_PER_TASK = 250_000
#: Most rows of a table of customers or products that is broadcast (about 100 bytes each).
BROADCAST_ROWS = 1_000_000
#: Bytes of a shuffle partition that adaptive execution makes of smaller ones: about as many whole orders, compressed.
TASK_BYTES = 16 << 20


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Within, the session has these settings."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def shuffle_width(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within, a shuffle has at least a partition for each ``ROWS_PER_TASK`` of ``rows``; a larger configured width stays.

    With a fixed width the partitions grow with the table until their sorts spill; adaptive execution joins small
    partitions up to ``TASK_BYTES``, but it cannot split those of a window or a sort. The shuffle files of a job go at its end: else those of all jobs
    lie on the disks until the driver happens to collect garbage. For jobs that run inside, not for returned plans.
    """
    key = "spark.sql.shuffle.partitions"
    width = str(max(int(spark.conf.get(key)), -(-rows // ROWS_PER_TASK)))
    advised = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    size = min(TASK_BYTES, spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(advised)))
    with settings(spark, {key: width, advised: f"{size}b", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield


def local_session(cores: int | str = "*", app: str = "ledgerflow", event_log_dir: str | None = None) -> SparkSession:
    """Session for tests and the local bench (never used by library code)."""
    builder = SparkSession.builder
    if event_log_dir:
        builder = (
            builder.config("spark.eventLog.enabled", "true")
            .config("spark.eventLog.dir", event_log_dir)
            .config("spark.eventLog.compress", "false")
            .config("spark.eventLog.rolling.enabled", "false")
        )
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local data: keep AQE from merging everything into one task
        # (a date-partitioned write of ~2,400 days from ONE task is 5x slower)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Uses ``spark.checkpoint.dir`` (or the SparkContext checkpoint dir) when the
    cluster names one.  Only a local-mode session without one gets a private
    directory under the system temp folder, as in tests.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a shared checkpoint folder is required on a cluster"
        )
    path = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), "tables", f"{name}-{uuid.uuid4().hex[:12]}")
