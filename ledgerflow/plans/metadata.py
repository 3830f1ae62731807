"""MD1-MD3: run log, data-quality log and table catalog as parquet tables.

The log tables are append-only (SNK6).  The catalog is keyed by
(table_name, layer) and maintained with the keyed upsert (SNK5): a repeated
registration updates row_count and last_updated only, location and format
keep their first values.  Each flush writes a new immutable catalog version
(``version=<n>``); readers take the newest committed one.  Each record is a one-row DataFrame built from a
few driver-side numbers (counts from observed metrics), never from data.
"""

from __future__ import annotations

import datetime as dt
import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import schemas as S
from ledgerflow.sinks import append, latest_version, prune_versions, upsert, write_version


class Warehouse:
    """Table locations under one root folder (bronze / silver / gold / meta)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # the pipeline's calendar, see README
        self._seq = time.time_ns() // 1000  # later processes go on with higher numbers
        self.pending_catalog: list[tuple] = []

    def path(self, layer: str, name: str) -> str:
        return os.path.join(self.root, layer, name)

    def next_seq(self) -> int:
        self._seq += 1
        return self._seq

    def read(self, layer: str, name: str, infer_partition_types: bool = True) -> DataFrame:
        """Read a table; ``infer_partition_types=False`` keeps partition values
        as strings (a 'yyyy-MM' period would otherwise be inferred as a date)."""
        if infer_partition_types:
            return self.spark.read.parquet(self.path(layer, name))
        key = "spark.sql.sources.partitionColumnTypeInference.enabled"
        prev = self.spark.conf.get(key)
        self.spark.conf.set(key, "false")
        try:
            return self.spark.read.parquet(self.path(layer, name))
        finally:
            self.spark.conf.set(key, prev)

    def read_latest(self, layer: str, name: str) -> DataFrame | None:
        """Newest committed version of a versioned table (None if none yet)."""
        path = latest_version(self.spark, self.path(layer, name))
        return None if path is None else self.spark.read.parquet(path)

    def exists(self, layer: str, name: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path(layer, name))
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(p)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def log_run(
    wh: Warehouse, name: str, layer: str, rows_read: int, rows_written: int,
    started: dt.datetime, finished: dt.datetime, error: str | None = None,
) -> None:
    """MD1 / MD2: one pipeline_runs row (status failed when ``error``)."""
    row = (
        uuid.uuid4().hex, name, layer, "failed" if error else "success", int(rows_read), int(rows_written),
        int((finished - started).total_seconds() * 1000), error, started, finished, wh.next_seq(),
    )
    df = wh.spark.createDataFrame([row], S.PIPELINE_RUNS)
    append(df, wh.path("meta", "pipeline_runs"))


def log_dq(wh: Warehouse, dq_rows: DataFrame) -> None:
    """DQ rows (table_name, layer, check_name, status, rows_tested, rows_failed)."""
    run_at = _now()
    seq = wh.next_seq()
    df = dq_rows.select(
        "table_name", "layer", "check_name", "status", "rows_tested", "rows_failed",
        F.lit(None).cast("string").alias("details"),
        F.lit(run_at).cast("timestamp").alias("run_at"),
        (F.lit(seq * 1000) + F.monotonically_increasing_id()).alias("seq"),
    )
    append(df, wh.path("meta", "dq_results"))


def register_table(wh: Warehouse, table: str, layer: str, location: str, row_count: int, schema_json: str | None = None) -> None:
    """MD3: queue a catalog registration; ``flush_catalog`` applies the queue
    as ONE upsert on (table_name, layer)."""
    wh.pending_catalog.append((table, layer, location, "parquet", int(row_count), None, _now(), schema_json))


def flush_catalog(wh: Warehouse) -> None:
    """Apply queued registrations: insert new (table, layer) keys; for known
    keys update row_count and last_updated only (location and format keep
    their first values).  Later registrations of a key win."""
    if not wh.pending_catalog:
        return
    latest: dict[tuple[str, str], tuple] = {}
    for row in wh.pending_catalog:  # a handful of metadata tuples, not data
        key = (row[0], row[1])
        first = latest.get(key)
        latest[key] = row if first is None else (*first[:4], row[4], row[5], row[6], row[7] or first[7])
    new = wh.spark.createDataFrame(list(latest.values()), S.TABLE_CATALOG)
    root = wh.path("meta", "table_catalog")
    current_path = latest_version(wh.spark, root)
    version = 0 if current_path is None else int(current_path.rsplit("=", 1)[1]) + 1
    merged = new if current_path is None else upsert(
        wh.spark.read.parquet(current_path), new, ["table_name", "layer"], ["row_count", "last_updated"]
    )
    # a new immutable version; the previous one stays readable until it commits
    write_version(merged, root, version)
    prune_versions(wh.spark, root)
    wh.pending_catalog.clear()
