"""Embedding whitening with MLlib's BlockMatrix.

Each distinct rounded vector is one row of a fit list.  Its rows are numbered and
centred, dealt into blocks, and the transposed matrix times the matrix is the
scatter.  Only that square of the dimension comes to the driver, for the
eigenvectors; the blocks times the whitening matrix are the projected rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .buckets import cut

#: Rows of a block, and blocks that a task of the scatter multiplies.
BLOCK_ROWS, BLOCKS_A_TASK = 4096, 4
WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
#: A component whose share of the variance is not above this has no direction of its own.
NO_VARIANCE = 1e-13


def _rounded(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id and x of the usable rows."""
    v = F.col("vector")
    usable = F.coalesce((F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0**63 / scale)), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where(usable)
    return rows.select("vec_id", F.transform(v, lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("x"))


def fit_list(rows: DataFrame) -> DataFrame:
    """x of each distinct vector, numbered without gaps by `index`."""
    mid = F.monotonically_increasing_id()
    held = cut(rows.select("x").distinct().select("x", F.shiftright(mid, 33).alias("part"), mid.bitwiseAND((1 << 33) - 1).alias("at")))
    counts = held.groupBy("part").agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return held.join(starts, "part").select("x", (F.col("start") + F.col("at")).alias("index"))


def scatter(matrix: BlockMatrix, tasks: int) -> np.ndarray:
    """The transposed matrix times the matrix; row blocks are dealt over tasks, which the JVM method takes as splits of the inner dimension."""
    turned = matrix.transpose()
    product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, tasks)
    return BlockMatrix(product, turned.rowsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def directions(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns, signed so that the largest entry is positive."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    largest = vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)


def whiten(vectors: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and each of the first components.

    Entries become x = floor(scale * entry).  Rows whose vector is null or empty, or holds
    a null, a value that is not finite, or one too large for a long, are left out;
    so are vectors of another length than the most frequent one (of ties the larger).
    Means, covariance and components are those of the distinct x, so a repeated
    vector weighs once.  Rows with a null or repeated id are rows like others.  A
    component without variance has a null `whitened`; if none has any,
    identity_error is null, and `explained` where the trace is zero.  A dimension
    under `components` gives as many components as it has.  An empty table, or one
    without usable rows, gives no rows; other columns are ignored.

    The driver holds squares of the dimension, never rows.  Sums are exact in 64
    bits, or the job fails (Spark's ANSI mode).
    """
    spark = vectors.sparkSession
    rows = _rounded(vectors, id_col, vector_col, scale)
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("d")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], WHITENED)
    d = lengths[0]["d"]
    rows = rows.where(F.size("x") == d)
    fit = cut(fit_list(rows))
    n = fit.count()
    sums = [r["s"] for r in fit.select(F.posexplode("x").alias("dim", "value")).groupBy("dim").agg(F.sum("value").alias("s")).orderBy("dim").collect()]
    total = F.lit(sums).cast("array<long>")
    off = F.zip_with("x", total, lambda a, s: F.lit(n).cast("long") * a - s)
    centred = F.transform(off, lambda a: a.cast("double") / n)
    indexed = MLUtils.convertVectorColumnsFromML(fit.select("index", array_to_vector(centred).alias("vector")), "vector")
    matrix = IndexedRowMatrix(indexed, n, d).toBlockMatrix(BLOCK_ROWS, d)
    covariance = scatter(matrix, max(1, math.ceil(n / BLOCK_ROWS / BLOCKS_A_TASK))) / n
    values, unit = directions(covariance, min(components, d))
    trace = float(np.trace(covariance))
    m = int((values > NO_VARIANCE * max(trace, 0.0)).sum()) if trace > 0 else 0
    explained = F.lit([float(e) / trace for e in values] if trace > 0 else [None] * len(values)).cast("array<double>")
    whitened, error = fit.select("index", F.lit(None).cast("array<double>").alias("w")), None
    if m:
        turn = unit[:, :m] / np.sqrt(values[:m])
        turn = BlockMatrix(spark.sparkContext.parallelize([((0, 0), Matrices.dense(d, m, turn.ravel(order="F").tolist()))], 1), d, m)
        projected = callMLlibFunc("getIndexedRows", matrix.multiply(turn).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
        whitened = cut(projected.select("index", vector_to_array("vector").alias("w")))
        w = [F.col("w")[i] for i in range(m)]
        moments = whitened.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(w)], *[F.avg(w[i] * w[j]).alias(f"c{i}_{j}") for i in range(m) for j in range(m)]).first()
        error = max(abs(moments[f"c{i}_{j}"] - moments[f"m{i}"] * moments[f"m{j}"] - (i == j)) for i in range(m) for j in range(m))
    measured = fit.select("x", "index", F.aggregate(off, F.lit(0).cast("long"), lambda a, b: a + b * b).alias("deviation")).join(whitened, "index").drop("index")
    out = rows.join(measured, "x").withColumn("component", F.explode(F.sequence(F.lit(1), F.lit(len(values)))))
    at = F.col("component") - 1
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", F.get("w", at).alias("whitened"), F.get(explained, at).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
