"""SRC1-SRC7: reading bronze / silver / gold tables.

* partitioned tables are read at their root (or with ``basePath``), so the
  year/month/day (or period) columns come from the directory names and a
  filter on them prunes directories;
* an explicit schema avoids schema inference over every footer;
* ``read_drifting`` handles files whose footers disagree on a column type
  (e.g. integer vs double discount), which ``mergeSchema`` and an enforced
  schema both reject: files are grouped by footer schema, each group is read
  with its own schema and cast to the target, and the groups are unioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_partitioned(spark: SparkSession, root: str, schema: T.StructType | None = None, glob: str | None = None) -> DataFrame:
    """SRC1 / SRC4: partition discovery from ``root``; ``glob`` narrows the
    files (e.g. ``year=2001/month=*/day=*/*.parquet``) while ``basePath``
    keeps the partition columns."""
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{root.rstrip('/')}/{glob}" if glob else root)


def read_snapshots(spark: SparkSession, pattern: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC2 / SRC3: every snapshot file matching ``pattern`` at once."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(pattern)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """All parquet files under ``root`` as a DataFrame (path, length); the
    listing is done by the file source, the content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length")
    )


def footer_schemas(files: DataFrame) -> DataFrame:
    """``files`` (column path, and others) with the footer of each file, read by executors (footers only)."""
    import json

    def read_footers(batches):
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        def open_schema(uri: str):
            if uri.startswith("file:"):
                return pq.read_schema(uri[len("file:"):].replace("///", "/", 1))
            # s3a:// and s3n:// are Hadoop names for the same object store
            uri = "s3://" + uri.split("://", 1)[1] if uri.startswith(("s3a://", "s3n://")) else uri
            filesystem, path = pafs.FileSystem.from_uri(uri)
            return pq.read_schema(path, filesystem=filesystem)

        for pdf in batches:
            out = []
            for p in pdf["path"]:
                sch = open_schema(p)
                out.append(json.dumps([[f.name, str(f.type)] for f in sch if f.name != "__index_level_0__"]))
            yield pdf.assign(footer=out)

    return files.mapInPandas(read_footers, T.StructType([*files.schema.fields, T.StructField("footer", T.StringType())]))


def _by_footer(files: DataFrame) -> DataFrame:
    """One row a distinct footer: its files, the most frequent footer first."""
    return (
        footer_schemas(files).groupBy("footer").agg(F.count("*").alias("n"), F.collect_list("path").alias("paths"))
        .orderBy(F.desc("n"), "footer")
    )


def read_files(files: DataFrame, target: T.StructType) -> DataFrame | None:
    """The rows of some files (column path), each group of equal footers with its own schema, cast to ``target``."""
    out = None
    for row in _by_footer(files).collect():
        part = cast_to(files.sparkSession.read.parquet(*row.paths), target, ())
        out = part if out is None else out.unionByName(part)
    return out


def cast_to(part: DataFrame, target: T.StructType, extra: Sequence[str] = ()) -> DataFrame:
    """The columns of ``target`` (NULL where ``part`` lacks one), and ``extra`` as whole numbers."""
    have = set(part.columns)
    cols = []
    for f in target.fields:
        c = F.col(f"`{f.name}`") if f.name in have else F.lit(None)
        if isinstance(f.dataType, T.DecimalType) and f.name in have and isinstance(part.schema[f.name].dataType, (T.DoubleType, T.FloatType)):
            c = c.cast("string")  # the shortest decimal text of a float is the number that was meant
        cols.append(c.cast(f.dataType).alias(f.name))
    return part.select(*cols, *[F.col(c).cast("int").alias(c) for c in extra])


def read_drifting(spark: SparkSession, root: str, target: T.StructType, partition_cols: Sequence[str] = ()) -> DataFrame:
    """SRC1-SRC3, SRC7: all files under ``root``, cast to ``target``, whatever types their footers have.

    Executors read the footers and group the files by footer; one row a distinct
    footer comes to the driver. With one footer, the root is read as usual. With several, each
    group is read with its own schema (a column that a file lacks is NULL) and
    cast. Partition columns in ``partition_cols`` are kept and can be filtered on.
    """
    groups = _by_footer(list_files(spark, root))
    first = groups.select("footer").limit(2).collect()
    if not first:
        return spark.createDataFrame([], T.StructType([*target.fields, *[T.StructField(c, T.IntegerType()) for c in partition_cols]]))
    reader = spark.read.option("basePath", root) if partition_cols else spark.read.option("recursiveFileLookup", "true")
    if len(first) == 1:
        return cast_to(reader.parquet(root), target, partition_cols)
    out = None
    for row in groups.collect():
        part = cast_to(reader.parquet(*row.paths), target, partition_cols)
        out = part if out is None else out.unionByName(part)
    return out
