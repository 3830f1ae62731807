"""Spark helpers shared by the llm operators."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import checkpoint_root, scratch_path

__all__ = ["checkpoint_root", "filter_rows", "materialize", "pick", "position", "scratch_path", "ship", "small_batches", "table", "text_and_id"]

_SHIPPED = "spark.ledgerflow.llm.shipped"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (once per application) with Spark's own file distribution.

    Executors then need no copy of the repository on their Python path.
    """
    if spark.conf.get(_SHIPPED, "") == spark.sparkContext.applicationId:
        return
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerflow-ship-"), "ledgerflow_pkg.zip")
    with open(path, "wb") as f:
        f.write(blob.getvalue())
    spark.sparkContext.addPyFile(path)
    spark.conf.set(_SHIPPED, spark.sparkContext.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared checkpoint folder and read it back.

    This cuts the lineage at a place that every executor can read again, so a
    lost executor costs a re-read and not a re-run of everything before it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Within, whole texts go to Python and back in batches of at most ``rows`` rows (jobs that run inside, not returned plans)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def position(df: DataFrame, name: str) -> int:
    """Where a column stands: the one called exactly so, else the first that differs in case only."""
    if name in df.columns:
        return df.columns.index(name)
    return [c.lower() for c in df.columns].index(name.lower())


def pick(df: DataFrame, **cols: tuple[str, str]) -> DataFrame:
    """Just the columns asked for: ``pick(df, out_name=(column, type))``.

    Columns are found by position, so the input may carry any other columns:
    names that differ in case only, or that the operator uses for its result.
    A column is the one called exactly so, else the first that differs in case only.
    """
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    at = {out: position(df, name) for out, (name, _) in cols.items()}
    return flat.select(*[F.col(f"c{at[out]}").cast(kind).alias(out) for out, (_, kind) in cols.items()])


def text_and_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id long, text string), whatever else the input carries."""
    return pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))


def filter_rows(docs: DataFrame, keep: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The rows of ``docs`` (all columns, as they are) for which ``keep`` gives True, in one scan.

    ``keep`` gets Arrow batches whose columns stand in the order of ``docs.columns``, which may clash in all but
    their place. Nulls, repeated rows and very long values pass as they are; an empty table stays empty.
    """
    ship(docs.sparkSession)
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep(batch), pa.bool_()))

    return flat.mapInArrow(run, flat.schema).toDF(*names)
