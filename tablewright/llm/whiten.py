"""Whitening of embeddings with distributed block matrices.

Entries become whole numbers first, so counts, sums and deviations are exact. The fit list holds
every distinct vector once. Its rows are centred, numbered and cut into blocks; the transposed
matrix times the matrix is the scatter, of which only the (dimensions x dimensions) result reaches
the driver. Its eigenvectors, scaled, are the whitening matrix, and a second block multiplication
projects all rows. A third one checks the covariance of the whitened fit list.

A matrix needs rows numbered without gaps: rows are written once with their number within the
task, and the counts of tasks, one small row each, give each task's first number. Blocks have a
fixed number of entries. The inner dimension of transposed times plain is split over as many tasks
as there are shuffle partitions, otherwise all blocks would meet in the single result block's
task. Rows are projected by their own number, not through their vector, so a vector that a third
of the rows share is no hot key; it is dropped from the fit list by a map-side aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import stage

#: entries of a block
ENTRIES = 1 << 18
SCALE, SHIFT = 64, 1_000_000
#: a component whose variance is below this share of the largest is rounding, not variance
NOISE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` distinct vectors with sums ``sums``; columns of ``matrix`` are components."""

    n: int
    sums: list[int]
    values: np.ndarray
    matrix: np.ndarray
    explained: list[float | None]
    identity_error: float | None


def whole_numbers(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id and x, numbered; rows whose vector is missing, empty or holds odd entries go.

    If vectors differ in length, those of the most frequent length stay (ties: the longer).
    """
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(vector, lambda c: F.floor(F.lit(SCALE) * c) + F.lit(SHIFT))
    kept = rows.where(vector.isNotNull() & ~F.coalesce(odd, F.lit(True)) & (F.size(vector) > 0)) \
        .select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), x.alias("x"))
    kept = placed(kept, "vectors")
    sizes = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head(2)
    return kept if len(sizes) < 2 else placed(kept.drop("place").where(F.size("x") == sizes[0].d), "vectors")


def placed(rows: DataFrame, name: str) -> DataFrame:
    """The rows as written, each with its ``place``: the writing task and its number within."""
    return stage(rows.withColumn("place", F.monotonically_increasing_id()), name)


def row_numbers(rows: DataFrame) -> DataFrame:
    """``row_number`` from 0 without gaps, by ``place``: a number within a task and that task's first."""
    task = F.shiftright("place", 33)
    ordinal = F.col("place").bitwiseAND((1 << 33) - 1)
    counts = rows.groupBy(task.alias("task")).count().orderBy("task").collect()  # a row for each task of a write
    if not counts:
        return rows.withColumn("row_number", F.lit(0).cast("long"))
    firsts = np.cumsum([0] + [r["count"] for r in counts])[:-1].tolist()
    spark = rows.sparkSession
    bases = spark.createDataFrame([(r.task, f) for r, f in zip(counts, firsts, strict=True)], "task long, first long")
    return rows.withColumn("task", task).join(F.broadcast(bases), "task").withColumn("row_number", F.col("first") + ordinal).drop("task", "first")


def _centred(n: int, sums: list[int]) -> Column:
    """x - S / n from exact whole numbers."""
    total = F.array(*[F.lit(s).cast("long") for s in sums])
    return F.transform(F.arrays_zip(F.col("x"), total.alias("s")), lambda p: (p["x"] * F.lit(n) - p["s"]).cast("double") / F.lit(float(n)))


def block_matrix(rows: DataFrame, vector: Column, n: int, d: int) -> BlockMatrix:
    """The vectors as rows of a matrix, by their ``row_number``."""
    table = rows.select(F.col("row_number").alias("index"), array_to_vector(vector).alias("vector"))
    table = MLUtils.convertVectorColumnsFromML(table, "vector")
    return IndexedRowMatrix(table, n, d).toBlockMatrix(max(1, ENTRIES // d), d)


def multiply(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """left x right, the inner dimension dealt over ``splits`` tasks a result block."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def scatter(rows: BlockMatrix, splits: int) -> np.ndarray:
    """Transposed x plain: a (columns x columns) array."""
    return multiply(rows.transpose(), rows, splits).toLocalMatrix().toArray()


def local(spark: SparkSession, matrix: np.ndarray) -> BlockMatrix:
    """A small matrix as one block."""
    block = Matrices.dense(*matrix.shape, matrix.ravel(order="F").tolist())
    return BlockMatrix(spark.sparkContext.parallelize([((0, 0), block)], 1), *matrix.shape)


@contextmanager
def kept(matrix: BlockMatrix) -> Iterator[BlockMatrix]:
    """The matrix, its blocks being held while it is used more than once; lost ones are made again."""
    yield matrix.persist(StorageLevel.MEMORY_AND_DISK)
    matrix._java_matrix_wrapper.call("blocks").unpersist(False)


def components_of(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest eigenvalues, unit eigenvectors over their roots as columns, and which have variance."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    real = values > NOISE * max(values[0], 0.0)
    return values, vectors * np.where(real, 1 / np.sqrt(np.where(real, values, 1.0)), 0.0), real


def fit(rows: DataFrame, components: int = 16) -> Whitening | None:
    """Components of the distinct vectors of ``rows`` (of ``whole_numbers``), None without rows."""
    spark = rows.sparkSession
    distinct = row_numbers(placed(rows.select("x").distinct(), "fit"))
    head = rows.select(F.size("x").alias("d")).head()
    if head is None:
        return None
    d, splits = head.d, int(spark.conf.get("spark.sql.shuffle.partitions"))
    totals = distinct.agg(F.count("*").alias("n"), *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]).first()
    n, sums = totals.n, list(totals[1:])
    with kept(block_matrix(distinct, _centred(n, sums), n, d)) as centred:
        covariance = scatter(centred, splits) / n
        values, matrix, real = components_of(covariance, components)
        with kept(multiply(centred, local(spark, matrix), 1)) as whitened:
            wrong = np.abs(scatter(whitened, splits) / n - np.eye(len(values)))[np.ix_(real, real)]
    trace = float(np.trace(covariance))
    return Whitening(n, sums, values, matrix, [float(v) / trace if trace > 0 else None for v in values],
                     float(wrong.max()) if wrong.size else None)


RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whiten(embeddings: DataFrame, components: int = 16) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    A row for every component of every row whose vector is whole and finite; repeated and missing
    ids keep their rows, and equal vectors get equal results. A component without variance (all
    vectors equal, or fewer distinct vectors than components) has null in ``whitened`` and takes
    no part in ``identity_error``, which is null if there is no other; ``explained`` is null if
    there is no variance at all. ``deviation`` is null where it exceeds a long. Vectors of another
    length than most are left out. An empty table gives no rows. Only vec_id and embedding are
    used, so further columns may have any name.
    """
    rows = whole_numbers(embeddings)
    fitted = fit(rows, components)
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], RESULT)
    numbered = stage(row_numbers(rows), "numbered")
    centred = block_matrix(numbered, _centred(fitted.n, fitted.sums), 0, len(fitted.sums))
    matrix = multiply(centred, local(embeddings.sparkSession, fitted.matrix), 1).toIndexedRowMatrix()
    values = callMLlibFunc("getIndexedRows", matrix._java_matrix_wrapper._java_model)
    values = MLUtils.convertVectorColumnsToML(values.toDF("row_number", "projected"), "projected") \
        .select("row_number", vector_to_array("projected").alias("projected"))
    total = F.array(*[F.lit(s).cast("long") for s in fitted.sums])
    deviation = F.expr("aggregate(transform(gaps, g -> try_multiply(g, g)), 0L, (a, b) -> try_add(a, b))")
    gaps = F.transform(F.arrays_zip(F.col("x"), total.alias("s")), lambda p: p["x"] * F.lit(fitted.n) - p["s"])
    shares = F.array(*[F.lit(e).cast("double") for e in fitted.explained])
    real = F.array(*[F.lit(bool(v > NOISE * max(fitted.values[0], 0.0))) for v in fitted.values])
    rows = numbered.select("row_number", "vec_id", gaps.alias("gaps")).select("row_number", "vec_id", deviation.alias("deviation"))
    return rows.join(values, "row_number").select("vec_id", "deviation", F.posexplode("projected").alias("place", "value")).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation",
        F.when(real[F.col("place")], F.col("value")).alias("whitened"), shares[F.col("place")].alias("explained"),
        F.lit(fitted.identity_error).cast("double").alias("identity_error"))
