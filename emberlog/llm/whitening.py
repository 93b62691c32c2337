"""Whitening of embeddings: principal components of unit variance, by distributed block matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.common import map_arrow, staged, workers_find_package

ROWS = 4096
COMPONENTS = 32
#: Entries beyond this, times 64, count as this.
LARGEST = 1 << 52


def whole_vectors(table: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, x): rows with finite vectors only, entries as whole numbers; vectors of another than the most frequent length are left out."""
    x = F.col("x")
    rows = table.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("x"))
    rows = rows.where(x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    lengths = rows.groupBy(F.size(x).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    held = lambda c: F.greatest(F.least(F.floor(c * 64), F.lit(LARGEST)), F.lit(-LARGEST))
    return rows.where(F.size(x) == d).withColumn("x", F.transform(x, lambda c: held(c) + F.lit(1_000_000)))


def row_blocks(rows: DataFrame, size: int) -> DataFrame:
    """(block, ids, x): rows numbered from 0 over all partitions, `size` of them in a block, the last one shorter."""
    rows = staged(rows.withColumn("at", F.monotonically_increasing_id()), "vectors")
    part, place = F.shiftrightunsigned("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    # One row per partition that was written: the rows in the partitions before it.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(part.alias("part")).count()
    base = counts.select("part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    numbered = rows.withColumn("part", part).join(base, "part").withColumn("row", F.col("base") + place)
    sorted_rows = F.sort_array(F.collect_list(F.struct("row", "id", "x")))  # at most `size` of them
    blocks = numbered.groupBy(F.expr(f"row div {size}").alias("block")).agg(sorted_rows.alias("rows"))
    return staged(blocks.select("block", F.col("rows.id").alias("ids"), F.col("rows.x").alias("x")), "vector-blocks")


def exact_sums(blocks: DataFrame) -> tuple[int, list[int]]:
    """The number of rows and the sum of every dimension, as whole numbers of any size."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column("x"):
                m = np.array(x.as_py(), dtype=np.int64)
                high, low = (m >> 32).sum(0), (m & 0xFFFFFFFF).sum(0)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(high)), pa.int32()), pa.array(np.full(len(high), len(m)), pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64())], ["d", "n", "high", "low"])

    total = map_arrow(blocks.select("x"), sums, "d int, n long, high long, low long").groupBy("d").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    rows = total.orderBy("d").collect()  # one per dimension
    return (rows[0]["n"] if rows else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def block_matrix(blocks: DataFrame, column: str, mean: list[float] | np.ndarray, size: int, n: int) -> BlockMatrix:
    """The centred rows as one column of blocks, kept for the reads of a product until they are released."""
    mean, d = np.asarray(mean), len(mean)
    workers_find_package(blocks.sparkSession)

    def block(row) -> tuple:
        value = row[1]
        x = np.frombuffer(value, "<f8").reshape(-1, d) if isinstance(value, (bytes, bytearray)) else np.array(value, dtype=np.float64)
        x = x - mean
        return (row[0], 0), DenseMatrix(len(x), d, x.ravel(order="F"))

    return BlockMatrix(blocks.select("block", column).rdd.map(block), size, d, n, d).persist(StorageLevel.MEMORY_AND_DISK)


def release(matrix: BlockMatrix) -> None:
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)  # the Python API only persists


def scatter(matrix: BlockMatrix, n_blocks: int, slots: int) -> np.ndarray:
    """Transpose times matrix. The rows are the inner dimension: without splits of it one task would get all blocks."""
    transposed = matrix.transpose()
    right = matrix._java_matrix_wrapper._java_model
    # BlockMatrix.multiply of the Python API lacks the number of splits.
    product = transposed._java_matrix_wrapper.call("multiply", right, max(1, min(n_blocks, slots)))
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def components_of(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues in falling order, the matrix that whitens, and the share of each in the trace.

    A component without variance (eigenvalue at rounding level) gets a zero column, so it whitens to 0.
    """
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:most]
    trace, values, vectors = float(np.trace(covariance)), values[order], vectors[:, order]
    some = values > max(values.max(initial=0), 0) * len(covariance) * np.finfo(float).eps
    root = np.sqrt(np.where(some, values, 1))
    return values, np.where(some, vectors / root, 0), np.where(some, values, 0) / (trace if trace > 0 else 1)


def whiten(table: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, size: int = ROWS) -> DataFrame:
    """One row per remaining row and component: id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds a null or non-finite entry are left out, and so are vectors of
    another length than the most frequent one (of equally frequent ones the longest). Null and repeated
    ids and equal rows stay, each with rows of its own; other columns are ignored; an empty table gives no
    rows. A component without variance, as all are for a single row, has whitened and explained 0
    and no part in identity_error. A deviation beyond a long is null. Entries beyond 2^46 count as 2^46.

    The covariance has a row per dimension and is the only matrix that reaches the driver, besides the
    numbers of the blocks, one per `size` rows; rows stay in blocks.
    """
    spark = table.sparkSession
    kind = table.schema[id].dataType.simpleString()
    schema = f"`{id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    blocks = row_blocks(whole_vectors(table, id, vector), size)
    n, sums = exact_sums(blocks)
    d = len(sums)
    if not n or not d:
        return spark.createDataFrame([], schema)
    n_blocks, slots = -(-n // size), max(2, spark.sparkContext.defaultParallelism)
    rows = block_matrix(blocks, "x", [s / n for s in sums], size, n)
    _, whitener, explained = components_of(scatter(rows, n_blocks, slots) / n, components)
    k = whitener.shape[1]
    projector = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(d, k, whitener.ravel(order="F")))], 1), d, k, d, k)
    projected = rows.multiply(projector).blocks.map(lambda b: (b[0][0], b[1].toArray().astype("<f8").tobytes()))
    whitened = staged(spark.createDataFrame(projected, "block long, z binary"), "whitened-blocks")
    release(rows)
    z_sums = np.array([r["s"] for r in map_arrow(whitened.select("z"), _column_sums(k), "c int, s double").groupBy("c").agg(F.sum("s").alias("s")).orderBy("c").collect()])
    centred = block_matrix(whitened, "z", z_sums / n, size, n)
    covariance = scatter(centred, n_blocks, slots) / n
    release(centred)
    some = np.flatnonzero(np.abs(whitener).sum(0))
    identity_error = float(np.abs(covariance - np.eye(k))[np.ix_(some, some)].max(initial=0))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x, z in zip(batch.column("ids"), batch.column("x"), batch.column("z")):
                far = deviations(np.array(x.as_py(), dtype=np.int64), n, sums)
                m = len(far)
                values = np.frombuffer(z.as_py(), "<f8")
                arrays = [
                    ids.values.take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n), pa.int64()),
                    pa.array(far, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(values), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, [id, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_arrow(blocks.join(whitened, "block").select("ids", "x", "z"), tell, schema)


def _column_sums(k: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for z in batch.column("z"):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(k), pa.int32()), pa.array(np.frombuffer(z.as_py(), "<f8").reshape(-1, k).sum(0))], ["c", "s"])

    return sums


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exact; None beyond a long."""
    most = n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, sums))
    if most < 1 << 62:
        far = n * x - np.array(sums, dtype=np.int64)
        if len(sums) * int(np.abs(far).max(initial=0)) ** 2 < 1 << 62:
            return (far * far).sum(1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]
