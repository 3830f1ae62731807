"""SNK1-SNK8: table writes and keyed upserts, all as Spark jobs.

* partitioned overwrite: a ``rebalance`` hint on the partition columns lets
  AQE cut the write into evenly sized tasks (a day that holds a third of all
  rows is split over many tasks and files instead of landing in one task).
  ``spread`` lets a grouping by key and the partitioned write after it share one shuffle.
* keyed upsert: a full outer join on the keys; rows are never collected to
  the driver and written one by one.
* versioned tables: a table that is updated in place gets a new immutable
  ``version=<n>`` folder per update; readers take the newest committed one,
  so a failed or retried update never damages the readable version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.session import ROWS_PER_TASK, scratch_path


def write_partitioned(
    df: DataFrame, path: str, partition_cols: Sequence[str], mode: str = "overwrite", dynamic: bool = False
) -> None:
    """SNK1 / SNK3.  ``dynamic=True`` replaces only the partitions present in
    ``df`` (incremental runs); the default replaces the whole table."""
    writer = df.hint("rebalance", *partition_cols).write.mode(mode).partitionBy(*partition_cols)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def spread(rows: DataFrame, partition_cols: Sequence[str], key: str) -> DataFrame:
    """``rows`` (a scan, read twice) shuffled by partition and block of ``key``, a new column ``_block``.

    A partition has a block for each ``ROWS_PER_TASK`` of its rows, so none is one task however many rows it has. Groups by
    ``partition_cols``, ``_block`` and ``key`` need no other shuffle, nor does ``write_spread``. A row a partition is broadcast.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "partition-sizes")
    at = [F.col(c).alias(f"_at_{i}") for i, c in enumerate(partition_cols)]
    rows.groupBy(*at).count().write.parquet(path)
    sizes = spark.read.parquet(path)
    total = sizes.agg(F.sum("count")).first()[0] or 0
    same = F.lit(True)
    for i, c in enumerate(partition_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_at_{i}"))
    block = F.pmod(F.xxhash64(key), F.ceil(F.col("count") / ROWS_PER_TASK)).alias("_block")
    dealt = rows.join(F.broadcast(sizes), same).select(*rows.columns, block)
    return dealt.repartition(max(spark.sparkContext.defaultParallelism, -(-total // ROWS_PER_TASK)), *partition_cols, "_block")


def write_spread(rows: DataFrame, path: str, partition_cols: Sequence[str], dynamic: bool = False) -> None:
    """SNK1 / SNK3 of rows that are dealt out by partition already: every task writes the partitions it has."""
    writer = rows.write.mode("overwrite").partitionBy(*partition_cols)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK2 / SNK7: unpartitioned parquet table (create or replace)."""
    df.write.mode(mode).parquet(path)


def write_clustered(df: DataFrame, path: str, key: str, row_group_mb: int = 16, mode: str = "overwrite") -> None:
    """An unpartitioned table laid out for lookups by ``key``: files hold disjoint, sorted ranges of it.

    A filter on the key then opens the one file and row group whose footer range holds it, and a Bloom filter in that
    footer spares the read of a key that is not there. Row groups are small, since a lookup reads a whole one. Rows with a null
    key come first. Ties of the key stay in one range: the key should be (nearly) unique.
    """
    laid_out = df.repartitionByRange(F.col(key).asc_nulls_first()).sortWithinPartitions(F.col(key).asc_nulls_first())
    writer = laid_out.write.mode(mode).option("parquet.block.size", row_group_mb << 20)
    writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.adaptive.enabled#{key}", "true").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """SNK6: append-only log table."""
    df.write.mode("append").parquet(path)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None) -> DataFrame:
    """SNK4 / SNK5: INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols.

    * key only in ``target``: row unchanged;
    * key only in ``updates``: row inserted as given;
    * key in both: ``update_cols`` take the new values (even NULL), every
      other column keeps the target's value.
    NULL keys never conflict (as with a unique index), so they are kept from
    both sides.  Keys are assumed unique within each input.
    """
    keys = list(keys)
    cols = target.columns
    update_cols = [c for c in (update_cols if update_cols is not None else cols) if c not in keys]
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t_hit"))
    u = updates.select(*[F.col(c).alias(f"_u_{c}") for c in cols], F.lit(True).alias("_u_hit"))
    cond = None
    for k in keys:
        e = F.col(f"_t_{k}") == F.col(f"_u_{k}")
        cond = e if cond is None else cond & e
    j = t.join(u, cond, "full_outer")
    both = F.col("_t_hit").isNotNull() & F.col("_u_hit").isNotNull()
    out = []
    for c in cols:
        if c in keys:
            # target rows keep their key; update-only rows bring theirs
            out.append(F.when(F.col("_t_hit").isNotNull(), F.col(f"_t_{c}")).otherwise(F.col(f"_u_{c}")).alias(c))
        elif c in update_cols:
            out.append(F.when(F.col("_u_hit").isNotNull(), F.col(f"_u_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            out.append(F.when(both | F.col("_u_hit").isNull(), F.col(f"_t_{c}")).otherwise(F.col(f"_u_{c}")).alias(c))
    return j.select(*out)


def replace_table(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with ``df`` even when ``df`` reads ``path`` itself.

    The result is first written whole next to the table; then the old folder is
    exchanged for it by two renames, so a failed job leaves either the old
    or the new table in place (or, between the renames, both side by side)."""
    spark = df.sparkSession
    fresh, old = f"{path.rstrip('/')}__new", f"{path.rstrip('/')}__old"
    df.write.mode("overwrite").parquet(fresh)
    fs, target = _hadoop(spark, path)
    _, new = _hadoop(spark, fresh)
    _, aside = _hadoop(spark, old)
    fs.delete(aside, True)
    if fs.exists(target):
        fs.rename(target, aside)
    fs.rename(new, target)
    fs.delete(aside, True)
    spark.catalog.refreshByPath(path)


def list_versions(spark, root: str, prefix: str, marker: str | None = "_SUCCESS") -> list[int]:
    """Committed versions (``<prefix><n>`` with a marker file; None: any), oldest first; a listing on the driver."""
    fs, path = _hadoop(spark, root)
    if not fs.exists(path):
        return []
    found = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix) and (marker is None or path_exists(spark, f"{root.rstrip('/')}/{name}/{marker}")):
            found.append(int(name[len(prefix):]))
    return sorted(found)


def latest_version(spark, root: str, before: int | None = None, prefix: str = "version=") -> str | None:
    """Folder of the newest committed version under ``root``; with ``before``, the newest strictly older one."""
    found = [n for n in list_versions(spark, root, prefix) if before is None or n < before]
    return f"{root.rstrip('/')}/{prefix}{found[-1]}" if found else None


def _hadoop(spark, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def write_mark(spark, path: str) -> None:
    """An empty file that says that something has begun."""
    fs, p = _hadoop(spark, path)
    fs.create(p, True).close()


def remove_path(spark, path: str) -> None:
    """Delete a table or folder of this pipeline (nothing if it is not there)."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def drop_partitions(spark, root: str, partitions: Sequence[dict]) -> None:
    """Remove partitions that have become empty: a dynamic overwrite only replaces partitions that have rows.
    Each is {column: value}, None for the partition of NULLs."""
    for values in partitions:
        name = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in values.items())
        remove_path(spark, f"{root.rstrip('/')}/{name}")


def list_days(spark, root: str) -> list[int]:
    """yyyymmdd of the day folders (year=/month=/day=) of a table, 0 for the one without a date; a listing, no scan."""
    fs, path = _hadoop(spark, f"{root.rstrip('/')}/year=*/month=*/day=*")
    found = []
    for st in fs.globStatus(path) or []:
        values = [part.partition("=")[2] for part in st.getPath().toString().rsplit("/", 3)[1:]]
        found.append(int(values[0]) * 10000 + int(values[1]) * 100 + int(values[2]) if all(v.isdigit() for v in values) else 0)
    return found


def prune_versions(spark, root: str, keep: int = 2, prefix: str = "version=") -> None:
    """Delete all but the newest ``keep`` committed versions (older ones have no readers left)."""
    found = list_versions(spark, root, prefix)
    for n in found[:-keep]:
        remove_path(spark, f"{root.rstrip('/')}/{prefix}{n}")


def write_version(df: DataFrame, root: str, version: int, prefix: str = "version=") -> None:
    """Write one immutable version of a table; readers take the newest
    committed one, so a failed write never damages the current version."""
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{prefix}{version}")


def cap(col: str, upper: float) -> "F.Column":
    """SNK8: coalesce to 0, then cap at ``upper`` (the serving-side guard)."""
    return F.least(F.coalesce(F.col(col), F.lit(0)), F.lit(upper))
