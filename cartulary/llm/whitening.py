"""Whitening of embeddings with MLlib's distributed block matrices.

Components become integers, so that sums over all rows are exact. Centred rows are indexed into the
blocks of a ``BlockMatrix``; its transpose times itself is the scatter matrix, of which only the
columns' number squared comes to the driver. Its eigenvectors, divided by the roots of the
eigenvalues, are the whitening matrix: one more block product projects the rows. The covariance of
the projected rows is measured by the same block product, not derived from the eigenvalues.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartulary.llm.common import stored

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Numbers in one block of a matrix: 2 MB of doubles, whatever the number of columns.
BLOCK_NUMBERS = 1 << 18
#: Row blocks that one task multiplies and adds up before results are shuffled.
BLOCKS_A_SPLIT = 16
SCHEMA = (
    "component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
)


def integers(table: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, x``: components as longs, of vectors that are not null and hold finite components only."""
    doubles = F.col("embedding").cast("array<double>")
    plain = F.forall(doubles, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return table.where(F.col("embedding").isNotNull() & plain).select(
        "vec_id", F.transform(doubles, lambda c: F.floor(F.lit(float(scale)) * c).cast("long") + F.lit(shift)).alias("x")
    )


def _indexed(rows: DataFrame) -> DataFrame:
    """Adds ``index``, 0 to n - 1 without gaps; ``rows`` is a stored table with ``_place``.

    Rows are counted by the task that wrote them, so only one number a task is summed up in order.
    """
    tasks = rows.groupBy(F.shiftright("_place", 33).alias("_task")).agg(F.count("*").alias("held"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = tasks.select("_task", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("_start"))
    own = rows.withColumn("_of", F.shiftright("_place", 33))
    return own.join(F.broadcast(starts), F.col("_of") == F.col("_task")).select(
        "vec_id", "x", (F.col("_start") + F.col("_place").bitwiseAND((1 << 33) - 1)).alias("index")
    )


def _sums(rows: DataFrame, columns: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each column; tasks add up their own rows first."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = 0, np.zeros(columns, object)
        for batch in batches:
            x = pc.list_flatten(batch.column("x")).to_numpy(zero_copy_only=False).reshape(len(batch), columns)
            total += x.sum(0).astype(object)
            held += len(batch)
        numbers = [held, *total.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(columns + 1), pa.int32()), pa.array(numbers, pa.int64())], ["place", "number"]
        )

    parts = rows.select("x").mapInArrow(add, "place int, number long").groupBy("place").agg(F.sum("number").alias("number"))
    numbers = [r["number"] for r in parts.orderBy("place").collect()]  # one for each column, and the count
    return (numbers[0], numbers[1:]) if numbers else (0, [])


def _vectors(table: DataFrame, values: Column) -> DataFrame:
    return MLUtils.convertVectorColumnsFromML(table.select("index", array_to_vector(values).alias("vector")), "vector")


def block_matrix(table: DataFrame, values: Column, rows: int, columns: int) -> BlockMatrix:
    """Rows with an ``index`` as the blocks of a matrix."""
    indexed = IndexedRowMatrix(_vectors(table, values), rows, columns)
    return indexed.toBlockMatrix(max(1, BLOCK_NUMBERS // columns), columns)


def _rows_of(matrix: BlockMatrix) -> DataFrame:
    """``index, values`` of a block matrix; rows stay in the JVM."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("values"))


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix, columns by columns.

    All row blocks add up to one result block. The product's second parameter, which the Python
    class leaves out, deals them over tasks first.
    """
    splits = max(1, -(-matrix.numRowBlocks // BLOCKS_A_SPLIT))
    left, right = matrix.transpose()._java_matrix_wrapper, matrix._java_matrix_wrapper._java_model
    return BlockMatrix(left.call("multiply", right, splits), matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def eigen(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order, and the unit eigenvectors as columns; each one's largest entry is positive."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    largest = np.abs(vectors).argmax(0)
    return values, vectors * np.where(vectors[largest, np.arange(len(values))] < 0, -1.0, 1.0)


def whiten(
    spark: SparkSession, table: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, one row for each vector and component.

    ``table`` has ``vec_id`` and ``embedding``. Vectors that are null, or hold null or non-finite
    components, give no rows. A covariance needs vectors of one length: those of the most frequent
    length (of equally frequent ones the longest) are whitened, others and empty ones give no rows.
    Zero vectors, null ids and repeated rows take part, each row for itself. A component without
    variance (constant columns, a single row) has null ``whitened``, and its ``identity_error``
    leaves it out; ``explained`` is null if no column varies. ``deviation`` is null where it is over
    63 bits; ``deviation_exact`` (a decimal) isn't. Other columns are ignored; an empty table gives no rows.
    """
    whole = integers(table, scale, shift)
    lengths = whole.groupBy(F.size("x").alias("columns")).agg(F.count("*").alias("held")).where("columns > 0")
    usual = lengths.orderBy(F.desc("held"), F.desc("columns")).take(1)
    columns = usual[0]["columns"] if usual else 1
    rows = stored(whole.where(F.size("x") == columns).withColumn("_place", F.monotonically_increasing_id()), "integers")
    held, sums = _sums(rows, columns)
    if not held:
        kind = table.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, {SCHEMA}")
    # n * x - S is exact; centred rows are that divided by n.
    sizes = F.lit(sums)
    rows = stored(_indexed(rows).withColumn("gap", F.zip_with("x", sizes, lambda c, s: c * F.lit(held) - s)).drop("x"), "centred")
    matrix = block_matrix(rows, F.transform("gap", lambda g: g / F.lit(float(held))), held, columns)
    values, vectors = eigen(scatter(matrix) / held)
    kept = min(components, columns)
    varies = values[:kept] > columns * np.finfo(float).eps * max(values[0], 0.0)
    weights = np.where(varies, vectors[:, :kept] / np.sqrt(np.where(varies, values[:kept], 1.0)), 0.0)
    block = spark.sparkContext.parallelize([((0, 0), DenseMatrix(columns, kept, weights.ravel(order="F").tolist()))], 1)
    projected = matrix.multiply(BlockMatrix(block, columns, kept, columns, kept))
    white = stored(_rows_of(projected).withColumnRenamed("index", "_index"), "whitened")
    error = _identity_error(white, held, kept, varies)
    total = float(values.clip(0).sum())
    shares = [max(float(v), 0.0) / total if total > 0 else None for v in values[:kept]]
    spread = [bool(v) for v in varies]
    return _result(rows, white, held, spread, shares, error)


def _identity_error(white: DataFrame, held: int, kept: int, varies: np.ndarray) -> float | None:
    """The largest entry of the whitened rows' covariance minus the identity, measured on the rows."""
    if not varies.any():
        return None
    means = white.select(*[F.avg(F.get("values", F.lit(k))) for k in range(kept)]).first()
    middle = F.lit([float(m) for m in means])
    centred = block_matrix(
        white.withColumnRenamed("_index", "index"), F.zip_with("values", middle, lambda v, m: v - m), held, kept
    )
    gap = scatter(centred) / held - np.eye(kept)
    return float(np.abs(gap[np.ix_(varies, varies)]).max())


def _result(
    rows: DataFrame, white: DataFrame, held: int, varies: list[bool], shares: list[float | None], error: float | None
) -> DataFrame:
    def add(total: Column, gap: Column) -> Column:
        return (total + gap.cast("decimal(19,0)") * gap.cast("decimal(19,0)")).cast("decimal(38,0)")

    exact = F.aggregate("gap", F.lit(0).cast("decimal(38,0)"), add)
    joined = rows.withColumn("deviation_exact", exact).select("vec_id", "index", "deviation_exact").join(
        white, F.col("index") == F.col("_index")
    )
    parts = F.zip_with("values", F.lit(varies), lambda v, able: F.when(able, v))
    single = joined.select("vec_id", "deviation_exact", F.posexplode(parts).alias("place", "whitened"))
    explained = F.array(*[F.lit(s).cast("double") for s in shares])
    return single.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(held).cast("long").alias("n"),
        F.expr("try_cast(deviation_exact AS bigint)").alias("deviation"),
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
        "deviation_exact",
    )
