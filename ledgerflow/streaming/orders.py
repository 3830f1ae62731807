"""ST1-ST2: incremental versions of the orders jobs (Structured Streaming).

The source lands a file per batch, with copies and late orders that may arrive at any
time. Both streams only say what has arrived; the tables are brought up to date
in ``foreachBatch`` by the same functions as the batch jobs, so nothing is dropped for being late:

* ST1 ``stream_clean_orders``: the micro-batch is merged into silver by order id over all
  days (``plans.incremental``). After every micro-batch silver equals a full rebuild of what has
  landed, on every column, in whatever order the files came. There is no watermark, and
  the state is a table (the kept copy of each order) instead of a state store.
* ST2 ``stream_daily_sales``: the micro-batch names the days it touched; those days are
  recomputed from the silver table and take the place of their old rows in the gold table.

The gold table of ST2 is versioned by epoch (``epoch=<n>`` folders): a micro-batch reads the
previous version and writes the next, so a retried epoch rewrites the same folder and
no path is read and overwritten by the same job. A retried ST1 batch merges the same rows
again, which changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerflow import schemas as S
from ledgerflow.operators.gold import daily_sales
from ledgerflow.plans.incremental import day_key, merge_orders
from ledgerflow.session import settings
from ledgerflow.sinks import latest_version as _latest
from ledgerflow.sinks import list_days, path_exists, prune_versions, write_version
from ledgerflow.sources.tables import read_files

#: What Spark's binaryFile source offers; only the path is read here.
_BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"
#: Files of one micro-batch: bounds the work that a failure repeats.
FILES_PER_BATCH = 10_000

#: The state lies in RocksDB on the executors' disks; what it holds in memory is bounded for each executor.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def _digest(columns: list[str]) -> list[Column]:
    """128 bits of the values of some columns and of which of them are null (the hash function skips nulls)."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return [F.xxhash64(F.lit(seed), nulls, *columns) for seed in (1, 2)]


def stream_clean_orders(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    max_files_per_trigger: int | None = FILES_PER_BATCH,
) -> StreamingQuery:
    """ST1: merge everything that has landed under ``src`` since the last run (``availableNow``).

    The stream itself reads only the names of the new files; the batch then reads those
    files with ``read_files``, which copes with footers of different types. The kept table is
    ``<dst>_kept``.
    """
    reader = spark.readStream.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        rows = read_files(batch.select("path"), S.BRONZE_ORDERS)
        if rows is not None:
            merge_orders(rows, f"{dst.rstrip('/')}_kept", dst)

    names = reader.schema(_BINARY_FILE).load(src).select("path")
    return names.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_deduped_orders(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    horizon: str = "7 days",
    max_files_per_trigger: int | None = FILES_PER_BATCH,
) -> StreamingQuery:
    """ST1 with bounded state, for feeds whose files share the bronze schema.

    Feeds deliver files again. The state store knows the rows that arrived within ``horizon``, by order id and a
    128-bit digest of the other columns; a row that is equal to one of them in every column is dropped there and costs no merge. All other rows are merged by order id as in
    ``stream_clean_orders``: new orders, changed copies, and copies that come when the state has forgotten theirs.
    The watermark runs over the time of arrival, so no row is ever late, and state is bounded by what arrives in the
    horizon. Silver equals the full rebuild with any horizon.
    """
    reader = spark.readStream.schema(S.BRONZE_ORDERS).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(src).withColumn("arrived", F.current_timestamp()).withWatermark("arrived", horizon)
    one, two = _digest([c for c in S.BRONZE_ORDERS.names if c != "order_id"])
    keyed = rows.withColumns({"_one": one, "_two": two})
    fresh = keyed.dropDuplicatesWithinWatermark(["order_id", "_one", "_two"]).drop("arrived", "_one", "_two")

    def merge(batch: DataFrame, epoch_id: int) -> None:
        merge_orders(batch, f"{dst.rstrip('/')}_kept", dst, spark)  # stages the batch first: the state is computed once

    with settings(spark, _STATE):  # the query starts with a copy of the session's settings
        return fresh.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_version(spark: SparkSession, root: str, before: int | None = None) -> str | None:
    """Folder of the newest committed epoch of an ST2 table."""
    return _latest(spark, root, before, prefix="epoch=")


def _replace_days(fresh: DataFrame, dst: str, epoch_id: int, days: list[int], open_days: list[int]) -> None:
    """The next version: the previous one without ``days`` and without days that silver no longer has, and ``fresh``."""
    session = fresh.sparkSession
    # the newest epoch BEFORE this one: a retried epoch never reads what it overwrites
    current = latest_version(session, dst, before=epoch_id)
    if current is not None:
        old = session.read.parquet(current)
        key = F.coalesce(F.date_format("date", "yyyyMMdd").cast("int"), F.lit(0))
        old = old.filter(~key.isin(days) & key.isin(open_days))
        fresh = old.unionByName(fresh)
    write_version(fresh, dst, epoch_id, prefix="epoch=")
    prune_versions(session, dst, prefix="epoch=")


def stream_daily_sales(
    spark: SparkSession,
    silver_src: str,
    dst: str,
    checkpoint: str,
    silver_schema: T.StructType,
    max_files_per_trigger: int | None = FILES_PER_BATCH,
) -> StreamingQuery:
    """ST2: follow the silver orders table with an up-to-date daily_sales table.

    Each micro-batch names the days whose files are new; they are recomputed with the batch
    ``daily_sales`` (a literal filter on year/month/day prunes the read to those
    folders). The day keys are one integer per calendar day in the batch.
    """
    reader = spark.readStream.schema(silver_schema).option("basePath", silver_src)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def recompute(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        days = [r[0] for r in batch.select(day_key().alias("k")).distinct().collect()]
        if not days or not path_exists(session, silver_src):
            return
        silver_now = session.read.option("basePath", silver_src).schema(silver_schema).parquet(silver_src)
        fresh = daily_sales(silver_now.filter(day_key().isin(days)))
        _replace_days(fresh, dst, epoch_id, days, list_days(session, silver_src))

    stream = reader.parquet(silver_src).select("year", "month", "day").writeStream.outputMode("append").foreachBatch(recompute)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
