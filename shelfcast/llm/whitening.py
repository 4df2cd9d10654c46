"""Embedding whitening with MLlib's block matrices.

The vectors are packed, where they are read, into blocks of a fixed number of rows and stored with the
block's row count and sums. The centred blocks are a distributed ``BlockMatrix``; its transpose times itself
is the scatter, whose few entries are decomposed on the driver; the blocks times the whitening matrix are
the projected rows. The middle dimension of the scatter is cut over as many tasks as there are shuffle partitions,
so that no task meets all blocks. A short last block of a task is filled with centred zeros, which
change no sum; the filling is cut off again after the projection.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfcast.llm.common import bounded, stage
from shelfcast.llm.vectors import fixed_point, usual_length

BLOCK = 1024
PARTS = 100_000
# An eigenvalue below this share of the largest is rounding noise of a direction without variance.
NO_VARIANCE = 1e-12


def packed(vectors: DataFrame, length: int, scale: int, offset: int, id_col: str, vector_col: str) -> DataFrame:
    """(part, blk, ids, x, rows, sums): up to ``BLOCK`` vectors a row, ``x`` their integers row by row."""
    wanted = vectors.select(F.spark_partition_id().alias("part"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "blk", "ids", "x", "rows", "sums"]
        kind, part, blk, ids, held = None, 0, 0, [], np.empty((0, length), dtype=np.int64)

        def block(n: int) -> pa.RecordBatch:
            nonlocal blk, ids, held
            here = pa.concat_arrays(ids)
            cut, held, ids = held[:n], held[n:], [here.slice(n)]
            lists = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            columns = [
                pa.array([part], pa.int32()),
                pa.array([blk], pa.int32()),
                lists(here.slice(0, n)),
                lists(pa.array(cut.ravel())),
                pa.array([n], pa.int32()),
                lists(pa.array(cut.sum(axis=0))),
            ]
            blk += 1
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            if batch.num_rows:
                part = batch.column(0)[0].as_py()
            at, x = fixed_point(batch.column(2), length, scale, offset)
            kind = batch.column(1).type
            ids.append(batch.column(1).take(pa.array(at, pa.int64())))
            held = np.concatenate([held, x])
            while len(held) >= BLOCK:
                yield block(BLOCK)
        if len(held):
            yield block(len(held))

    kind = wanted.schema["id"].dataType.simpleString()
    return wanted.mapInArrow(run, f"part int, blk int, ids array<{kind}>, x array<long>, rows int, sums array<long>")


def numbered(blocks: DataFrame) -> DataFrame:
    """Stored blocks with ``at``, 0 upwards without gaps: the blocks of the parts before, and the own number."""
    counts = blocks.groupBy("part").agg(F.count("*").alias("blocks"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task of the scan
    starts = counts.select("part", F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("start"))
    return blocks.join(bounded(starts, PARTS), "part").withColumn("at", F.col("start") + F.col("blk")).drop("part", "blk", "start")


MATRIX_BLOCK = StructType(
    [
        StructField("_1", StructType([StructField("_1", LongType()), StructField("_2", LongType())])),
        StructField("_2", MatrixUDT()),
    ]
)


def centred(blocks: DataFrame, n: int, sums: list[int], count: int) -> BlockMatrix:
    """The block matrix of x - S/n; the difference n * x - S is taken in integers."""
    length = len(sums)
    total = np.array(sums, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = x.values.to_numpy().reshape(-1, length)
                full = np.zeros((BLOCK, length))
                full[: len(rows)] = (n * rows - total) / n
                none = pa.array([None], pa.list_(pa.int32()))
                matrix = pa.StructArray.from_arrays(
                    [
                        pa.array([1], pa.int8()),
                        pa.array([BLOCK], pa.int32()),
                        pa.array([length], pa.int32()),
                        none,
                        none,
                        pa.ListArray.from_arrays(pa.array([0, full.size], pa.int32()), pa.array(full.ravel())),
                        pa.array([True]),
                    ],
                    names=["type", "numRows", "numCols", "colPtrs", "rowIndices", "values", "isTransposed"],
                )
                key = pa.StructArray.from_arrays([pa.array([at], pa.int64()), pa.array([0], pa.int64())], names=["_1", "_2"])
                yield pa.RecordBatch.from_arrays([key, matrix], names=["_1", "_2"])

    frame = blocks.select("at", "x").mapInArrow(run, MATRIX_BLOCK)
    java = callMLlibFunc("createBlockMatrix", frame, BLOCK, length, BLOCK * count, length)
    return BlockMatrix(java, BLOCK, length)


def scatter(matrix: BlockMatrix, splits: int) -> np.ndarray:
    """The transpose times the matrix, summed over ``splits`` parts of the middle dimension."""
    turned = matrix.transpose()
    java = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, turned.rowsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def projected(spark: SparkSession, matrix: BlockMatrix, weights: np.ndarray) -> DataFrame:
    """(at, z): the blocks of the matrix times ``weights``, ``z`` column by column."""
    length, width = weights.shape
    block = DenseMatrix(length, width, weights.ravel(order="F").tolist())
    other = BlockMatrix(spark.sparkContext.parallelize([((0, 0), block)], 1), length, width, length, width)
    product = matrix.multiply(other)
    frame = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model)
    at, matrix_col = frame.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = batch.column(0).field(0), batch.column(1)
            values, turned = found.field("values"), found.field("isTransposed").to_pylist()
            out = []
            for i, flat in enumerate(turned):
                z = values[i].values.to_numpy().reshape((BLOCK, width), order="C" if flat else "F")
                out.append(z.ravel(order="F"))
            yield pa.RecordBatch.from_arrays([keys.cast(pa.int64()), pa.array(out, pa.list_(pa.float64()))], names=["at", "z"])

    return frame.select(at, matrix_col).mapInArrow(run, "at long, z array<double>")


def whiten(
    vectors: DataFrame,
    components: int = 8,
    scale: int = 1024,
    offset: int = 100_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each vector and component.

    Entries become the integers x = floor(scale * entry) + offset. The covariance V of all vectors (divisor
    n) is decomposed; component 1 has the largest eigenvalue e. ``whitened`` is x - S/n projected on the
    component, over sqrt(e); ``explained`` is e over the trace of V; ``deviation`` sums (n * x - S)^2 exactly and
    is null where 64 bits do not hold it; ``identity_error`` is the largest absolute entry of the whitened
    rows' measured covariance minus the identity.

    Vectors that are null, hold null or non-finite entries, or entries of 2^53 and more at this scale, take no part, nor do
    those of another length than the most frequent one. Repeated rows each take part; ids may be null.
    There are at most as many components as entries. A component without variance has null ``whitened``
    and is left out of ``identity_error``; ``explained`` is null where nothing varies. Other columns are not
    read; a table without vectors gives an empty result. The driver holds matrices of the vectors' length only.
    """
    spark = vectors.sparkSession
    length = usual_length(vectors, vector_col)
    kind = vectors.schema[id_col].dataType.simpleString()
    blocks = stage(packed(vectors, length, scale, offset, id_col, vector_col), "vector-blocks")
    whole = blocks.agg(F.sum("rows"), F.count("*")).first()
    if not whole[0] or not length:
        return spark.createDataFrame(
            [], f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
    n, count = whole
    by_place = blocks.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).collect()  # one row an entry
    sums = [row["s"] for row in sorted(by_place, key=lambda row: row["pos"])]
    blocks = numbered(blocks)
    matrix = centred(blocks, n, sums, count)
    matrix.persist(StorageLevel.MEMORY_AND_DISK)
    splits = max(1, min(count, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    covariance = scatter(matrix, splits) / n
    values, vectors_of = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[: min(components, length)]
    values, weights, trace = values[order], vectors_of[:, order], float(np.trace(covariance))
    varies = values > max(values[0], 0) * NO_VARIANCE
    with np.errstate(all="ignore"):
        weights = np.where(varies, weights / np.sqrt(values), 0.0)
    width = len(order)
    rows = stage(projected(spark, matrix, weights), "whitened-blocks")
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)
    error = _identity_error(rows, n, width, varies)
    total = np.array(sums, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x, z in zip(batch.column(0), batch.column(1), batch.column(2)):
                moved = n * x.values.to_numpy().reshape(-1, length) - total
                fits = (moved.astype(np.float64) ** 2).sum(axis=1) < 9.2e18
                deviation = pa.array((moved * moved).sum(axis=1), mask=~fits)
                places = pa.array(np.tile(np.arange(len(moved)), width))
                component = np.repeat(np.arange(width), len(moved))
                whitened = z.values.to_numpy().reshape(width, BLOCK)[:, : len(moved)].ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(places),
                        pa.array(component + 1, pa.int32()),
                        deviation.take(places),
                        pa.array(whitened, mask=~varies[component]),
                        pa.array(values[component] / trace if trace > 0 else np.zeros(len(component)), mask=np.full(len(component), trace <= 0)),
                    ],
                    names=[id_col, "component", "deviation", "whitened", "explained"],
                )

    both = blocks.join(rows, "at").select("ids", "x", "z")
    out = both.mapInArrow(run, f"`{id_col}` {kind}, component int, deviation long, whitened double, explained double")
    return out.select(
        id_col, "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error")
    )


def _identity_error(rows: DataFrame, n: int, width: int, varies: np.ndarray) -> float:
    """Largest absolute entry of the projected rows' covariance minus the identity, measured on the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for z in batch.column(0):
                block = z.values.to_numpy().reshape(width, BLOCK)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([[*block.sum(axis=1), *(block @ block.T).ravel()]], pa.list_(pa.float64()))], names=["m"]
                )

    sums = rows.select("z").mapInArrow(run, "m array<double>").select(F.posexplode("m")).groupBy("pos").agg(F.sum("col").alias("s"))
    flat = np.array([row["s"] for row in sorted(sums.collect(), key=lambda row: row["pos"])])  # width + width^2 rows
    mean = flat[:width] / n
    gram = flat[width:].reshape(width, width) / n - np.outer(mean, mean)
    gaps = np.abs(gram - np.eye(width))[np.ix_(varies, varies)]
    return float(gaps.max()) if gaps.size else 0.0
