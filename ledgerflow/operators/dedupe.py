"""DD1: keep one row per key, deterministically.

``dropDuplicates`` keeps an arbitrary survivor, so two passes over the same
input may keep different rows.  Here the survivor is the first row by an
explicit column order followed by every remaining column, i.e. a total order.

Plan shape: ``row_number() = 1`` over ``partitionBy(keys)`` is planned as a
partial ``WindowGroupLimit`` before the shuffle and a final one after it, so
a key that holds a third of all rows is cut to one row per map task before it
is shuffled (no single task receives the hot group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.session import scratch_path

#: Most keys that ``split_strays`` broadcasts (8 bytes each).
MAX_STRAYS = 1_000_000


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    keys = list(keys)
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order + rest])
    return df.withColumn("_keep_rn", F.row_number().over(w)).filter(F.col("_keep_rn") == 1).drop("_keep_rn")


def split_strays(rows: DataFrame, key: str, place: Column) -> tuple[DataFrame, DataFrame | None] | None:
    """(rows of keys whose rows all lie in one ``place``, rows of the other keys or None if there are none), for a scan read twice.

    ``place`` is a whole number. Keys are compared by a 64-bit hash, by a shuffle of hashes and numbers alone; a null key is a
    key. None if more than ``MAX_STRAYS`` keys lie in several places.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "strays")
    hashed = rows.withColumn("_hash", F.xxhash64(key))
    ends = hashed.groupBy("_hash").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
    ends.where("lo <> hi").select("_hash").write.parquet(path)
    strays = spark.read.schema("_hash long").parquet(path)
    found = strays.count()  # from Parquet footers
    if found > MAX_STRAYS:
        return None
    if not found:
        return rows, None
    home, astray = (hashed.join(F.broadcast(strays), "_hash", how).select(*rows.columns) for how in ("left_anti", "left_semi"))
    return home, astray
