"""Embedding whitening with MLlib's BlockMatrix.

The entries are rounded down to 1/256, so that sums are exact in whole numbers. The fit list is
every distinct vector once. Its rows, less the mean, are indexed into a distributed BlockMatrix; the transpose
multiplied by it is the scatter matrix (d x d), whose eigenvectors numpy finds on the driver. A
second BlockMatrix of all rows, multiplied by the d x k whitening matrix, projects them.

MLlib multiplies all blocks that lead to one block of the result in one task. The scatter matrix is a single block,
so its product is split along the rows (``numMidDimSplits``) into as many tasks as there
are blocks, and these partial products are summed.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from ledgerflow.llm.common import materialize, pick

#: Steps of the grid that entries are rounded down to.
SCALE = 256
COMPONENTS = 4
#: Numbers of a block (8 bytes each).
BLOCK_VALUES = 1 << 18
#: Eigenvalues below this share of the trace are rounding, no component.
LEAST_SHARE = 1e-12

_RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written with a gapless number ``at``: rows before its partition, plus its place in it."""
    stored = materialize(rows.withColumn("mark", F.monotonically_increasing_id()), name)
    part = F.shiftright("mark", 33)
    sizes = stored.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.col("mark") - F.shiftleft(part, 33)
    return stored.join(starts, part == F.col("part")).withColumn("at", F.col("start") + place).drop("mark", "part", "start")


def _blocks(rows: DataFrame, values: Column, dim: int) -> BlockMatrix:
    """Indexed rows (at, values) as a BlockMatrix with all columns in each block; kept, as a product reads its blocks several times."""
    indexed = MLUtils.convertVectorColumnsFromML(rows.select("at", array_to_vector(values).alias("v")), "v")
    return IndexedRowMatrix(indexed, numCols=dim).toBlockMatrix(max(1, BLOCK_VALUES // dim), dim).persist(StorageLevel.MEMORY_AND_DISK)


def _product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """MLlib's ``multiply(other, numMidDimSplits)``, which the Python class offers without its second argument."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def _components(scatter: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of the covariance, and its trace."""
    covariance = (scatter + scatter.T) / (2 * n)
    trace = float(np.trace(covariance))
    values, vectors = np.linalg.eigh(covariance)
    first = np.argsort(-values, kind="stable")[:most]
    first = first[values[first] > LEAST_SHARE * trace]
    return values[first], vectors[:, first], trace


def _whiten(rows: DataFrame, dim: int, most: int) -> DataFrame | None:
    """The result for the rows (vec_id, x) of one length."""
    spark = rows.sparkSession
    rows = _numbered(rows, "whitening-rows")
    # the fit list: of equal vectors the row with the smallest number
    fit = materialize(rows.groupBy("x").agg(F.min("at").alias("at")), "whitening-fit")
    n, *sums = fit.agg(F.count("*"), *[F.sum(F.col("x")[i]) for i in range(dim)]).first()
    mean = [s / n for s in sums]
    total, average = F.lit(sums), F.lit(mean)
    centred = F.zip_with("x", average, lambda a, m: a - m)

    a = _blocks(fit, centred, dim)
    scatter = _product(a.transpose(), a, max(1, a.numRowBlocks)).toLocalMatrix().toArray()
    values, vectors, trace = _components(scatter, n, most)
    k = len(values)
    if not k:
        return None
    weights = Matrices.dense(dim, k, (vectors / np.sqrt(values)).ravel(order="F").tolist())
    w = BlockMatrix(spark.sparkContext.parallelize([((0, 0), weights)], 1), dim, k)
    moved = _blocks(rows, centred, dim).multiply(w).toIndexedRowMatrix().rows.map(lambda r: (r.index, r.vector.toArray().tolist()))
    projected = materialize(moved.toDF("at long, whitened array<double>"), "whitening-projected")

    fitted = projected.join(fit.select("at"), "at")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    covariances = fitted.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) for i, j in pairs]).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(covariances, pairs, strict=True))

    off = F.zip_with("x", total, lambda v, s: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), v), s))
    squares = F.aggregate(off, F.lit(0).cast("long"), lambda acc, d: F.try_add(acc, F.try_multiply(d, d)))
    out = rows.select("at", "vec_id", squares.alias("deviation")).join(projected, "at")
    return out.select(
        "vec_id", F.posexplode("whitened").alias("i", "whitened"), "deviation"
    ).select(
        "vec_id",
        (F.col("i") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.lit([float(v / trace) for v in values])[F.col("i")].alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows projected on the leading unit eigenvectors of the covariance, at unit variance: one row a vector and component.

    vec_id, component (from 1), n (size of the fit list), deviation (sum over the dimensions of (n x - S)^2, x
    being the entries in 1/256 rounded down and S their sums), whitened, explained
    (eigenvalue over trace) and identity_error (how far the covariance of the whitened fit list is from the identity at most).

    Defined cases: rows whose vector is null or holds a null, NaN or infinite entry are left out, as are empty vectors;
    a null id stays; repeated rows each give their rows and count once in the fit; vectors of
    different lengths are fitted length by length (the number of lengths is bounded by the longest vector); components without variance
    (equal vectors, fewer dimensions than components) give no rows; a deviation beyond 64 bits is null; of equal eigenvalues
    any order; extra columns are ignored; an empty table gives no rows.
    """
    kind = vectors.schema[vec_col].dataType
    element = "float" if isinstance(kind, T.ArrayType) and kind.elementType == T.FloatType() else "double"
    good = pick(vectors, vec_id=(id_col, "long"), vec=(vec_col, f"array<{element}>")).where(
        "vec is not null and size(vec) > 0 and forall(vec, v -> v is not null and not isnan(v) and abs(v) < double('infinity'))"
    )
    grid = F.transform("vec", lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    good = good.select("vec_id", grid.alias("x"))
    lengths = sorted(r[0] for r in good.select(F.size("x").alias("d")).distinct().collect())  # a number a length
    parts = [_whiten(good.where(F.size("x") == d), d, components) for d in lengths]
    out = None
    for part in parts:
        if part is not None:
            out = part if out is None else out.unionByName(part)
    return vectors.sparkSession.createDataFrame([], _RESULT) if out is None else out
