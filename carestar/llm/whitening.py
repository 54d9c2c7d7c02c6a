"""Whitening of embeddings by products of MLlib block matrices."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestar.llm.common import stored
from carestar.session import scratch_dir

SCALE, SHIFT = 64, 1_000_000
# Entries beyond this have no fixed-point value that arithmetic on longs keeps exact.
_LARGEST = float(1 << 40)
_MATRIX = MatrixUDT.sqlType().simpleString()
_FILE_BLOCKS = 8
_TASK_BLOCKS = 64


def fixed_point(vector: Column) -> Column:
    """floor(64 c) + 1000000 of each entry, as longs."""
    return F.transform(vector, lambda c: F.floor(SCALE * c.cast("double")) + SHIFT)


def usable(vector: Column) -> Column:
    """No null or non-finite entry, none too large for fixed point, at least one entry."""
    held = F.forall(
        vector,
        lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) <= _LARGEST / SCALE), F.lit(False)),
    )
    return F.coalesce(held, F.lit(False)) & (F.size(vector) > 0)


@dataclass(frozen=True)
class Centre:
    """The number of distinct vectors and their exact sums, for the commonest length."""

    n: int
    sums: tuple[int, ...]

    @property
    def width(self) -> int:
        return len(self.sums)

    def differences(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n x - sums, exact, and x less the mean. Whole parts go first, so numbers stay small."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        exact = (x - whole) * np.int64(self.n) - rest
        return exact, exact / self.n


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """Each x once; equal ones combine before the shuffle."""
    return vectors.select("x").distinct()


def centre_of(fit: DataFrame) -> Centre:
    """Sums by dimension, added up in the tasks first: the driver gets one row a dimension."""
    lengths = fit.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("width")).first()
    if top is None:
        return Centre(0, ())
    width = top["width"]

    def add(batches):
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += batch.column(0).flatten().to_numpy().reshape(-1, width).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total)], ["at", "s"])

    parts = fit.where(F.size("x") == width).mapInArrow(add, "at int, s long")
    sums = {r["at"]: r["s"] for r in parts.groupBy("at").agg(F.sum("s").alias("s")).collect()}
    return Centre(top["n"], tuple(sums[k] for k in range(width)))


def _square_sums(exact: np.ndarray) -> list[int | None]:
    """Sums of squares as longs; None where a long cannot hold one."""
    if not exact.size or float(np.abs(exact).max()) ** 2 * exact.shape[1] < 2.0**62:
        return (exact * exact).sum(axis=1).tolist()
    sums = [sum(v * v for v in row) for row in exact.tolist()]
    return [s if s < 1 << 63 else None for s in sums]


_ARROW_MATRIX = pa.struct(
    [
        ("type", pa.int8()),
        ("numRows", pa.int32()),
        ("numCols", pa.int32()),
        ("colPtrs", pa.list_(pa.int32())),
        ("rowIndices", pa.list_(pa.int32())),
        ("values", pa.list_(pa.float64())),
        ("isTransposed", pa.bool_()),
    ]
)
_BLOCK = pa.schema(
    [
        ("part", pa.int32()),
        ("nth", pa.int64()),
        ("col", pa.int32()),
        ("rows", pa.int32()),
        ("matrix", _ARROW_MATRIX),
        ("ids", pa.list_(pa.int64())),
        ("deviations", pa.list_(pa.int64())),
    ]
)


def blocks_of(vectors: DataFrame, centre: Centre, height: int, columns: int) -> DataFrame:
    """Centred rows of (id, x) as blocks (part, nth, col, rows, matrix, ids, deviations).

    A task makes its blocks from its own rows as they come, without a shuffle. The last block of
    a task is filled up with zero rows, which add nothing to a product; ``rows`` is the number
    of real ones. Ids and deviations come with the first block column.
    """
    width = centre.width
    names = _BLOCK.names

    def block(part, nth, x, ids):
        exact, centred = centre.differences(x)
        full = np.zeros((height, width))
        full[: len(x)] = centred
        rows = []
        for col, low in enumerate(range(0, width, columns)):
            values = full[:, low : low + columns]
            matrix = {
                "type": 1, "numRows": height, "numCols": values.shape[1], "colPtrs": None,
                "rowIndices": None, "values": values.ravel(), "isTransposed": True,
            }
            own = (ids, _square_sums(exact)) if col == 0 else (None, None)
            rows.append((part, nth, col, len(x), matrix, *own))
        return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=_BLOCK)

    def build(batches):
        part, nth = TaskContext.get().partitionId(), 0
        x, ids = np.zeros((0, width), np.int64), []
        for batch in batches:
            more = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            x, ids = np.concatenate([x, more]), ids + batch.column(0).to_pylist()
            while len(x) >= height:
                yield block(part, nth, x[:height], ids[:height])
                x, ids, nth = x[height:], ids[height:], nth + 1
        if len(x):
            yield block(part, nth, x, ids)

    schema = (
        f"part int, nth long, col int, rows int, matrix {_MATRIX}, ids array<long>, deviations array<long>"
    )
    return vectors.where(F.size("x") == width).select("id", "x").mapInArrow(build, schema)


@dataclass(frozen=True)
class Blocks:
    """Stored blocks: the matrix they make, and what belongs to their rows."""

    matrix: BlockMatrix
    owners: DataFrame  # row (of blocks), rows, ids, deviations
    rows: int


def stored_blocks(blocks: DataFrame, height: int, columns: int, width: int) -> Blocks:
    """The blocks as a matrix. They are written first, so that no product computes them anew,
    and read as MLlib's matrix type, which has the same fields inside.

    Block rows are numbered by task and place in it. Numbers of a short task's last places
    stay free, which stands for zeros."""
    spark = blocks.sparkSession
    path = scratch_dir(spark, "blocks")
    blocks.write.option("maxRecordsPerFile", _FILE_BLOCKS).parquet(path)
    held = spark.read.schema(blocks.schema).parquet(path)
    stride, parts = held.agg(F.coalesce(F.max("nth"), F.lit(0)) + 1, F.coalesce(F.max("part"), F.lit(0)) + 1).first()
    typed = T.StructType([f if f.name != "matrix" else T.StructField("matrix", MatrixUDT()) for f in blocks.schema])
    row = F.col("part") * F.lit(stride) + F.col("nth")
    place = F.struct(row.cast("long"), F.col("col").cast("long"))
    table = spark.read.schema(typed).parquet(path).select(place.alias("place"), "matrix")
    rows = stride * parts
    made = callMLlibFunc("createBlockMatrix", table, height, columns, rows * height, width)
    owners = held.where("col = 0").select(row.alias("row"), "rows", "ids", "deviations")
    return Blocks(BlockMatrix(made, height, columns), owners, rows)


def product(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """a b; the dimension they share is dealt over ``splits`` tasks for each block of the result."""
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def scatter(matrix: BlockMatrix, rows: int, parallel: int) -> np.ndarray:
    """The matrix, transposed, times itself: square, of its columns, on the driver."""
    splits = max(-(-rows // _TASK_BLOCKS), min(rows, parallel))
    return product(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()


def small_matrix(spark: SparkSession, values: np.ndarray, height: int) -> BlockMatrix:
    """A matrix of the driver, in blocks of ``height`` rows and all columns."""
    rows = []
    for k, low in enumerate(range(0, len(values), height)):
        part = values[low : low + height]
        rows.append(((k, 0), DenseMatrix(*part.shape, part.ravel().tolist(), True)))
    schema = T.StructType(
        [T.StructField("place", T.StructType([T.StructField(c, T.LongType()) for c in "rc"])), T.StructField("m", MatrixUDT())]
    )
    made = callMLlibFunc("createBlockMatrix", spark.createDataFrame(rows, schema), height, values.shape[1], *values.shape)
    return BlockMatrix(made, height, values.shape[1])


def unfolded(projected: BlockMatrix, owners: DataFrame, height: int, components: int) -> DataFrame:
    """(id, component, deviation, whitened) of a projection, whose blocks meet the ids and
    deviations of their rows."""
    blocks = callMLlibFunc("getMatrixBlocks", projected._java_matrix_wrapper._java_model)
    # Written as MLlib's type and read as its fields, of which the values are columns in a row.
    path = scratch_dir(owners.sparkSession, "projected")
    blocks.write.option("maxRecordsPerFile", _FILE_BLOCKS).parquet(path)
    read = owners.sparkSession.read.schema("_1 struct<_1:int,_2:int>, _2 struct<values:array<double>>").parquet(path)
    values = read.select(F.col("_1._1").cast("long").alias("row"), F.col("_2.values").alias("values"))
    cells = F.expr(
        f"transform(sequence(0, rows * {components} - 1), j -> struct("
        f"ids[j div {components}] as id, cast(j % {components} + 1 as int) as component, "
        f"deviations[j div {components}] as deviation, "
        f"values[cast((j % {components}) * {height} + j div {components} as int)] as whitened))"
    )
    return owners.join(values, "row").select(F.inline(cells))


def whiten(
    vectors: DataFrame,
    components: int = 16,
    height: int = 2048,
    columns: int = 1024,
    least: float = 1e-10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row for each usable vector and component: id, component, n, deviation, whitened,
    explained, identity_error.

    Entries become fixed-point longs (``fixed_point``). The fit list holds each distinct vector
    once: n of them, with exact sums. Centred rows go into blocks of ``height`` rows and at most
    ``columns`` columns; the block matrix, transposed, times itself is the scatter, of which the
    driver takes the eigenvectors (width x width numbers). The blocks of all rows times the
    whitening matrix project them. ``deviation`` is the exact sum of (n x - sums)^2 (null where a
    long cannot hold it), ``explained`` the component's share of the trace, ``identity_error``
    the largest entry by which the covariance of the whitened fit list differs from the identity;
    that list has mean zero as its rows are centred exactly. MLlib keeps the places of blocks on
    the driver, two numbers for ``height`` rows.

    A vector that is null, empty or holds a null, non-finite or too large entry (beyond 2^34) is
    left out; so are vectors of other lengths than the commonest (of equally common ones the
    longest). Components of an eigenvalue below ``least`` times the largest have no direction and
    are not given: there are fewer where few or alike vectors span fewer, none for a single one. A
    null id is kept; repeated rows are answered each; an empty table gives no rows. Other columns
    are not read.
    """
    spark = vectors.sparkSession
    schema = (
        f"`{id_column}` long, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    vector = F.col(vector_column)
    rows = vectors.where(usable(vector)).select(
        F.col(id_column).cast("long").alias("id"), fixed_point(vector).alias("x")
    )
    fit = stored(distinct_vectors(rows), "fit")
    centre = centre_of(fit)
    if centre.n < 2:
        return spark.createDataFrame([], schema)
    parallel = spark.sparkContext.defaultParallelism
    columns = min(columns, centre.width)
    shape = height, columns, centre.width
    without_ids = fit.withColumn("id", F.lit(None).cast("long"))
    listed = stored_blocks(blocks_of(without_ids, centre, height, columns), *shape)
    covariance = scatter(listed.matrix, listed.rows, parallel) / centre.n
    values, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    values, directions = values[::-1], directions[:, ::-1]
    k = min(components, int((values > least * max(values[0], 0.0)).sum()))
    if not k:
        return spark.createDataFrame([], schema)
    weights = small_matrix(spark, directions[:, :k] / np.sqrt(values[:k]), columns)
    whitened_fit = product(listed.matrix, weights)
    error = np.abs(scatter(whitened_fit, listed.rows, parallel) / centre.n - np.eye(k)).max()
    everything = stored_blocks(blocks_of(rows, centre, height, columns), *shape)
    cells = unfolded(product(everything.matrix, weights), everything.owners, height, k)
    explained = F.array(*[F.lit(float(v)) for v in values[:k] / np.trace(covariance)])
    return cells.select(
        F.col("id").alias(id_column),
        "component",
        F.lit(centre.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("component") - 1).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
