"""Embedding whitening with Spark MLlib block matrices.

Every component becomes an integer (``floor(scale * c) + shift``), so equal vectors,
sums and deviations are exact.  The fit list holds each distinct vector once.  Its
centred rows are indexed into the blocks of a ``BlockMatrix``; the transpose times
the matrix is the scatter, whose eigenvectors are found locally (width squared
numbers), and the matrix times the whitening matrix projects the rows.  Rows that
share a vector are joined to its projection, so copies are projected once.

A block matrix deals a tall grid of blocks to about the square root of its
partitions, and a multiplication holds the blocks of one such part together.  So the
fit list is worked in panels of ``PANEL_ROWS`` rows, which bounds a part whatever the
size of the table; scatters of panels are added up.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayflow.session import materialize, scratch_path

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
BLOCK_ROWS = 4096          # 2 MB of doubles at 64 components
BLOCKS_TOGETHER = 8        # blocks that one task of the scatter multiplies
PANEL_ROWS = 1 << 24
KEPT = StorageLevel.MEMORY_AND_DISK     # made again from the written fit list if lost
LOW_BITS = 33              # a generated row number: partition above, position below


def lattice(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """``floor(scale * c) + shift`` of each component; null if any is null or not finite."""
    x = lambda c: c.cast("double")
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(x(c)) | (F.abs(x(c)) == math.inf))
    return F.when(~bad, F.transform(vector, lambda c: F.floor(x(c) * scale) + F.lit(shift)))


def numbered(df: DataFrame, name: str, index: str) -> DataFrame:
    """``df`` written once, with consecutive numbers from 0 in column ``index``."""
    table = materialize(df.withColumn(index, F.monotonically_increasing_id()), name)
    part = F.shiftright(index, LOW_BITS)
    counts = table.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    at = F.col("start") + F.col(index).bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    # one row per write task: bounded by the number of partitions
    return (table.join(F.broadcast(starts), part == F.col("part"))
            .select(*[c for c in df.columns], at.alias(index)))


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` distinct vectors: sums, eigenvalues (falling) and whitening matrix."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    trace: float
    matrix: np.ndarray          # width x components: eigenvectors over root eigenvalues

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.eigenvalues]


def _less(x: Column, model_n: int, sums: tuple[int, ...]) -> Column:
    """``n * x - S`` per component, exact."""
    return F.zip_with(x, F.array(*[F.lit(s).cast("bigint") for s in sums]),
                      lambda a, s: a * F.lit(model_n).cast("bigint") - s)


def deviation(x: Column, n: int, sums: tuple[int, ...]) -> Column:
    """Sum over components of ``(n * x - S) ** 2`` as ``decimal(38,0)``, exact."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.aggregate(_less(x, n, sums), F.lit(0).cast("decimal(38,0)"),
                       lambda acc, d: (acc + wide(d) * wide(d)).cast("decimal(38,0)"))


def _panels(fit: DataFrame, n: int, panel_rows: int) -> list[DataFrame]:
    """Index ranges of the fit list, renumbered from 0."""
    return [fit.filter((F.col("at") >= lo) & (F.col("at") < lo + panel_rows))
            .withColumn("at", F.col("at") - lo) for lo in range(0, n, panel_rows)]


def block_matrix(rows: DataFrame, n_rows: int, width: int, block_rows: int) -> BlockMatrix:
    """Rows ``(at, array of doubles)`` as a block matrix of whole-width blocks."""
    vectors = MLUtils.convertVectorColumnsFromML(
        rows.select(F.col("at").alias("index"), array_to_vector(rows.columns[1]).alias("vector")),
        "vector")
    return IndexedRowMatrix(vectors, n_rows, width).toBlockMatrix(block_rows, width)


def scatter(matrix: BlockMatrix, n_blocks: int) -> np.ndarray:
    """Transpose times matrix; row blocks are dealt to as many tasks as they need."""
    splits = max(1, -(-n_blocks // BLOCKS_TOGETHER))
    wrapped = matrix._java_matrix_wrapper
    product = matrix.transpose()._java_matrix_wrapper.call(
        "multiply", wrapped._java_model, splits)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def _projected(spark: SparkSession, matrix: BlockMatrix, weights: np.ndarray) -> BlockMatrix:
    """Matrix times a local matrix, which is one block."""
    d, k = weights.shape
    block = DenseMatrix(d, k, weights.flatten("F").tolist())
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), block)], 1), d, k, d, k)
    return matrix.multiply(right)


def _indexed_rows(matrix: BlockMatrix) -> DataFrame:
    """``(index, vector)`` of a block matrix as a frame, without a Python pass."""
    return callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper
                         ._java_model)


def principal(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling positive eigenvalues of ``v`` and their eigenvectors, largest entry positive."""
    e, u = np.linalg.eigh((v + v.T) / 2)
    e, u = e[::-1], u[:, ::-1]
    keep = e > max(e[0], 0.0) * len(e) * np.finfo(float).eps if len(e) else e > 0
    e, u = e[keep][:components], u[:, keep][:, :components]
    sign = np.sign(u[np.abs(u).argmax(0), np.arange(len(e))])
    return e, u * sign


def whiten(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT, block_rows: int = BLOCK_ROWS,
           panel_rows: int = PANEL_ROWS) -> tuple[DataFrame, Whitening, float]:
    """``vectors`` with a column ``whitening``, the model and its identity error.

    ``whitening`` is a struct of ``deviation`` (decimal, exact) and ``values`` (the
    whitened components, by falling eigenvalue).  Rows whose vector is null or holds a
    null or non-finite component are dropped; null ids and repeated rows stay, each row
    with its values.  Shorter vectors count as padded with zeros.  Components of no
    variance have no whitened value, so there are fewer than ``components`` if the
    vectors span less; a table of no rows or of one distinct vector has none.  All of
    the caller's columns stay (one named ``whitening`` is replaced).

    Eigenvalues are of the covariance (divisor n) of the fit list, whose rows are
    centred before they are multiplied.  The identity error is the largest entry of the
    whitened fit list's covariance less the identity, computed from the projected rows.
    """
    spark = vectors.sparkSession
    rows = (vectors.drop("whitening")
            .select(F.struct("*").alias("row"), lattice(F.col(vector_col), scale, shift).alias("x"))
            .filter("x is not null"))
    width = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    padding = F.array_repeat(F.lit(shift).cast("bigint"), F.lit(width) - F.size("x"))
    rows = rows.withColumn("x", F.concat("x", padding))
    # a digest of the whole vector stands for it where rows meet their projection
    key = F.unhex(F.sha2(F.array_join(F.col("x").cast("array<string>"), ",").cast("binary"), 256))
    rows = rows.withColumn("key", key)
    fit = numbered(rows.select("key", "x").distinct(), "whitening-fit", "at")
    n = fit.count()
    sums = tuple(r.s for r in fit.select(F.posexplode("x").alias("dim", "c"))
                 .groupBy("dim").agg(F.sum("c").alias("s")).orderBy("dim").collect())
    out = scratch_path(spark, "whitening-projected")
    if not n or not width:
        model = Whitening(n, sums, np.empty(0), 0.0, np.empty((width, 0)))
        none = F.struct(deviation(F.col("x"), n, sums).alias("deviation"),
                        F.array().cast("array<double>").alias("values"))
        return rows.select("row.*", none.alias("whitening")), model, 0.0
    centred = F.transform(_less(F.col("x"), n, sums), lambda d: d / F.lit(float(n)))
    panels = []
    for part in _panels(fit.select("at", "x"), n, panel_rows):
        size = min(panel_rows, n - len(panels) * panel_rows)
        blocks = block_matrix(part.select("at", centred.alias("y")), size, width,
                              min(block_rows, size))
        panels.append((blocks, -(-size // block_rows)))
    v = np.zeros((width, width))
    for blocks, count in panels:
        blocks.persist(KEPT)            # a multiplication reads its blocks four times
        v += scatter(blocks, count)
        blocks._java_matrix_wrapper.call("blocks").unpersist(False)
    v /= n
    values, u = principal(v, components)
    model = Whitening(n, sums, values, float(np.trace(v)), u / np.sqrt(values))
    k = len(values)
    if not k:
        none = F.struct(deviation(F.col("x"), n, sums).alias("deviation"),
                        F.array().cast("array<double>").alias("values"))
        return rows.select("row.*", none.alias("whitening")), model, 0.0
    total = np.zeros((k, k))
    for p, (blocks, count) in enumerate(panels):
        white = _projected(spark, blocks, model.matrix)
        white.persist(KEPT)
        (_indexed_rows(white)
         .select((F.col("index") + p * panel_rows).alias("at"),
                 vector_to_array("vector").alias("values"))
         .write.mode("append").parquet(out))
        total += scatter(white, count)
        white._java_matrix_wrapper.call("blocks").unpersist(False)
    error = float(np.abs(total / n - np.eye(k)).max())
    whitened = (fit.select("at", "key", deviation(F.col("x"), n, sums).alias("deviation"))
                .join(spark.read.parquet(out), "at")
                .select("key", F.struct("deviation", "values").alias("whitening")))
    return rows.select("row", "key").join(whitened, "key").select("row.*", "whitening"), model, error
