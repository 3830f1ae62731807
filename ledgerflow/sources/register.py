"""Footer register: which types the files of a landing folder have, without opening a file twice.

The register is a stored table (path, length, footer, folder, landing) next to a root that files keep landing in.
``refresh`` lists the root, opens the footers of files that are not registered (by path and length) and appends
them. ``read`` joins the listing with the register, so a file that is gone or was replaced never counts
with its old footer, and reads by class of footer and folder: the driver gets a row a folder, and file names only of folders
in which files of different types lie side by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.session import scratch_path
from ledgerflow.sinks import append, path_exists
from ledgerflow.sources.tables import cast_to, footer_schemas, list_files

_SCHEMA = "path string, length long, footer string"


def landing_key(path: Column) -> Column:
    """yyyymmdd of a file's year=/month=/day= folder as a number; 0 without one."""
    part = [F.regexp_extract(path, f"/{c}=(\\d+)/", 1) for c in ("year", "month", "day")]
    y, m, d = (F.when(p != "", p.cast("int")) for p in part)
    return F.coalesce(y * 10000 + m * 100 + d, F.lit(0))


class FooterRegister:
    """The register at ``path`` of the Parquet files under ``root``."""

    def __init__(self, spark: SparkSession, root: str, path: str):
        self.spark, self.root, self.path = spark, root.rstrip("/"), path

    def entries(self) -> DataFrame:
        """All registered files, also those that are gone by now."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(self.path)

    def refresh(self) -> DataFrame:
        """Register what is new; the files that are there now (path, length, footer, folder, landing).

        A run that dies while it appends leaves the new files unregistered: the next run opens them again.
        """
        known = self.entries().select("path", "length")
        fresh = list_files(self.spark, self.root).join(known, ["path", "length"], "left_anti")
        append(footer_schemas(fresh).select("path", "length", "footer"), self.path)
        listed = list_files(self.spark, self.root)
        entries = self.entries().dropDuplicates(["path", "length"])
        folder = F.regexp_replace("path", "/[^/]*$", "")
        now = listed.join(entries, ["path", "length"]).withColumns({"folder": folder, "landing": landing_key(F.col("path"))})
        staged = scratch_path(self.spark, "register")
        now.write.parquet(staged)
        return self.spark.read.parquet(staged)

    def read(self, target: T.StructType, partition_cols=(), since: int | None = None, before: int | None = None) -> DataFrame:
        """The rows of all files, or of those that landed from ``since`` on or before ``before`` (yyyymmdd), cast to ``target``.

        Files in no landing folder are in both. Partition columns in ``partition_cols`` are kept.
        """
        files = self.refresh()
        everything = since is None and before is None
        if since is not None:
            files = files.where((F.col("landing") >= since) | (F.col("landing") == 0))
        if before is not None:
            files = files.where(F.col("landing") < before)
        reader = self.spark.read.option("basePath", self.root) if partition_cols else self.spark.read.option("recursiveFileLookup", "true")
        classes = files.select("footer").distinct().limit(2).collect()
        if everything and len(classes) == 1:
            return cast_to(reader.parquet(self.root), target, partition_cols)
        out = None
        for paths in self._places(files):
            part = cast_to(reader.parquet(*paths), target, partition_cols)
            out = part if out is None else out.unionByName(part)
        if out is None:
            return self.spark.createDataFrame([], T.StructType([*target.fields, *[T.StructField(c, T.IntegerType()) for c in partition_cols]]))
        return out

    def _places(self, files: DataFrame) -> list[list[str]]:
        """For each class of footer the folders that hold only it, and its files in folders of several classes."""
        kinds = files.groupBy("folder").agg(F.count_distinct("footer").alias("kinds"), F.count("*").alias("n"), F.min("footer").alias("footer"))
        pure = kinds.where("kinds = 1").select("footer", F.col("folder").alias("place"))
        mixed = files.join(kinds.where("kinds > 1").select("folder"), "folder").select("footer", F.col("path").alias("place"))
        places: dict[str, list[str]] = {}
        for r in pure.unionByName(mixed).orderBy("footer", "place").collect():
            places.setdefault(r.footer, []).append(r.place)
        return list(places.values())
