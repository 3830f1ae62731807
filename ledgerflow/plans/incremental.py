"""Incremental silver orders that equal a full rebuild, whatever lands and whenever.

The silver dedupe keeps, of all copies of an order id, the first by a total order. That
choice can be merged: the first of all copies is the first of (the kept old copy, the new copies). So
next to silver there is a *kept* table with the chosen copy of every order id, before any
row is dropped (``plans.kept``). New rows are merged into it by order id, over
all days: a copy may land days late, may move an order to another day, or may have no
readable date (its own partition). Its index confines the read to the buckets that may hold an id of the batch.
Only the days whose kept rows changed are rewritten in silver, from their silver
rows and the changed orders, and a day that loses its last row loses its partition.

Merging the same rows twice changes nothing, so a failed run is simply repeated; silver
is written before the kept table for that reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions import parse_ts
from ledgerflow.operators.silver import finish_orders, write_stored_orders
from ledgerflow.plans.kept import COLUMNS, DAY, KEPT, KeptOrders, choose
from ledgerflow.session import scratch_path
from ledgerflow.sinks import drop_partitions, list_days, path_exists, remove_path, write_partitioned


def day_key(year="year", month="month", day="day"):
    """yyyymmdd as a number; 0 for rows without a readable date."""
    return F.coalesce(F.col(year) * 10000 + F.col(month) * 100 + F.col(day), F.lit(0))


def _stage(df: DataFrame, name: str, spark: SparkSession | None = None, paths: list[str] | None = None) -> DataFrame:
    """Write and reread an intermediate result, with ``spark`` in that session; its path goes to ``paths``."""
    spark = spark or df.sparkSession
    path = scratch_path(spark, name)
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class _Stages:
    """Intermediate results of one merge, which are of no use after it."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        return _stage(df, name, self.spark, self.paths)

    def drop(self, keep: int = 0) -> None:
        """Remove them all, but for the last ``keep``."""
        while len(self.paths) > keep:
            remove_path(self.spark, self.paths.pop(0))


def _replace_days(rows: DataFrame, path: str, days: list[int]) -> None:
    """Make ``rows`` the whole content of the given days of a table."""
    write_partitioned(rows, path, DAY, dynamic=True)
    filled = {r[0] for r in rows.select(day_key().alias("k")).distinct().collect()}  # at most one number a day
    gone = [k for k in days if k not in filled]
    drop_partitions(rows.sparkSession, path, [dict(zip(DAY, _parts(k), strict=True)) for k in gone])


def _parts(key: int) -> tuple[int | None, int | None, int | None]:
    return (key // 10000, key // 100 % 100, key % 100) if key else (None, None, None)


def rebuild_kept(bronze: DataFrame, kept_path: str) -> None:
    """The kept table of everything in ``bronze``, a scan of files (created_at as text)."""
    rows = bronze.withColumn("created_at", parse_ts("created_at"))
    KeptOrders(bronze.sparkSession, kept_path).write_base(rows, bronze.count())  # from Parquet footers


def _silver_days(spark: SparkSession, path: str, days: list[int]) -> DataFrame:
    """The silver rows of some days (a literal filter on the partition columns); none if there is no table yet."""
    schema = finish_orders(spark.createDataFrame([], KEPT).select(*COLUMNS)).schema
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path).where(day_key().isin(days))


def _first_orders(bronze: DataFrame, kept: KeptOrders, silver_path: str) -> list[int]:
    """Merge of rows (a scan of files) into nothing: silver and the kept table as a full run makes them; returns the event days."""
    rows = bronze.count()  # from Parquet footers
    if not rows:
        return []
    write_stored_orders(bronze, silver_path)
    kept.write_base(bronze.withColumn("created_at", parse_ts("created_at")), rows)
    return sorted(list_days(bronze.sparkSession, silver_path))


def merge_orders(bronze: DataFrame, kept_path: str, silver_path: str, spark: SparkSession | None = None) -> list[int]:
    """Merge newly landed rows; returns the rewritten event days (yyyymmdd, 0 for no date).

    One number a calendar day, and one a bucket of the kept table, come to the driver; rows never do.
    A micro-batch with state has a session without adaptive execution, in which ``rebalance`` does nothing and every task
    writes a file a day: ``spark`` is the session for everything after the batch itself is staged.
    """
    spark = spark or bronze.sparkSession
    kept = KeptOrders(spark, kept_path)
    stage = _Stages(spark)
    try:
        if not kept.exists() and not path_exists(spark, silver_path):
            return _first_orders(stage(bronze, "landed"), kept, silver_path)
        return _merge(bronze, kept, silver_path, stage)
    finally:
        stage.drop()


def _merge(bronze: DataFrame, kept: KeptOrders, silver_path: str, stage: _Stages) -> list[int]:
    new = stage(choose(bronze.withColumn("created_at", parse_ts("created_at"))), "landed")
    old = stage(kept.lookup(new, stage), "kept-before").withColumn("copy", F.struct(*KEPT.names))
    best = choose(new.unionByName(old.drop("copy")))
    was = old.select("order_id", "copy")
    both = best.withColumn("now", F.struct(*KEPT.names)).join(was, "order_id", "left")
    changed = stage(both.where(~F.col("now").eqNullSafe(F.col("copy"))).select(*KEPT.names, F.col("copy").isNotNull().alias("known"),
                                                                             *[F.col(f"copy.{c}").alias(f"old_{c}") for c in DAY]), "changed")
    stage.drop(keep=1)
    before = changed.where("known").select(day_key(*[f"old_{c}" for c in DAY]).alias("k"))
    days = sorted(r[0] for r in changed.select(day_key().alias("k")).union(before).distinct().collect())
    if not days:
        return []
    fresh = finish_orders(changed.select(*COLUMNS))
    rest = _silver_days(stage.spark, silver_path, days).join(changed.select("order_id"), "order_id", "left_anti")
    rows = stage(rest.select(*fresh.columns).unionByName(fresh), "days")
    _replace_days(rows, silver_path, days)
    kept.append(changed)
    return days
