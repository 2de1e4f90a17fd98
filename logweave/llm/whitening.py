"""Embedding whitening with MLlib's distributed block matrices.

Components become whole numbers first, so that repeats and sums are exact.  Each
distinct vector is one row of the fit: the rows are numbered, centred on the exact
mean, and indexed into blocks, which are written.  As a ``BlockMatrix`` one block
wide, its transpose times itself is the scatter matrix; the eigenvectors of that
are local.  The same blocks laid out as a square grid, times the whitening matrix
on the diagonal, are the projected rows.  Vectors that repeat share the projection
of their row of the fit.

Two properties of MLlib's product decide the layout.  It sends a block to the task
of its result block, and the scatter matrix is one block: the long side is
therefore split (``BLOCKS_PER_TASK``) and the partial products are added.  And it
cuts a result of r by c blocks into a square grid of tasks, so a result one block
wide would get the square root of the tasks asked for.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.llm.fingerprint import let
from logweave.llm.rows import ranked
from logweave.plans.sizing import settled, small_side
from logweave.session import scratch_dir

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16

# Rows of a block; more where there would be over MOST_BLOCKS blocks, as MLlib lists them in the driver.
BLOCK_ROWS = 1024
MOST_BLOCKS = 1 << 20
BLOCKS_PER_TASK = 16
# Vectors of different lengths are fitted apart, one after the other.
MOST_LENGTHS = 32

_INDEX = T.StructType([T.StructField("_1", T.LongType()), T.StructField("_2", T.LongType())])


def whole(vector: Column) -> Column:
    """``floor(SCALE * c) + SHIFT`` of every entry; null if an entry is null, not finite, or no long then."""
    fits = float(1 << 62)

    def usable(c: Column) -> Column:
        return c.isNotNull() & (F.abs(F.lit(float(SCALE)) * c.cast("double")) < fits)

    def one(c: Column) -> Column:
        return F.floor(F.lit(float(SCALE)) * c.cast("double")) + F.lit(SHIFT).cast("long")

    return F.when(F.forall(vector, usable), F.transform(vector, one))


def _name(x: str) -> list[Column]:
    """128 bits that name a vector where rows meet their row of the fit."""
    return [F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2")]


def column_sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    sums = [F.sum(F.col("x")[j].cast("decimal(38,0)")) for j in range(width)]
    found = fit.agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("sums")).first()
    return found["n"], [int(s) for s in found["sums"]]


def _from_mean(n: int, sums: list[int]) -> tuple[Column, Column]:
    """Every entry less the floor of its mean, and what is left of the sums, 0 to n - 1."""
    floors = F.array(*(F.lit(s // n).cast("long") for s in sums))
    rest = F.array(*(F.lit(s % n).cast("long") for s in sums))
    return F.zip_with("x", floors, lambda x, m: x - m), rest


def deviation(n: int, sums: list[int]) -> Column:
    """The sum over entries of ``(n * x - S)**2``, exact; null where it is no long."""
    near, rest = _from_mean(n, sums)

    def square(a: Column, r: Column) -> Column:
        apart = F.try_subtract(F.try_multiply(F.lit(n).cast("long"), a), r)
        return let(apart, lambda d: F.try_multiply(d, d))

    return F.aggregate(F.zip_with(near, rest, square), F.lit(0).cast("long"), F.try_add)


def centred(n: int, sums: list[int]) -> Column:
    near, rest = _from_mean(n, sums)
    return F.zip_with(near, rest, lambda a, r: a.cast("double") - r.cast("double") / F.lit(float(n)))


def in_blocks(rows: DataFrame, rows_per_block: int, width: int) -> DataFrame:
    """Rows (``rank``, ``row``) as written matrices by ``block``; the last is filled up with zeros."""
    place = F.struct((F.col("rank") % rows_per_block).alias("at"), "row")
    grouped = rows.groupBy(F.floor(F.col("rank") / rows_per_block).cast("int").alias("block"))
    grouped = grouped.agg(F.flatten(F.array_sort(F.collect_list(place))["row"]).alias("values"))
    missing = F.lit(rows_per_block * width) - F.size("values")
    matrix = F.struct(
        F.lit(1).cast("tinyint").alias("type"),
        F.lit(rows_per_block).alias("numRows"),
        F.lit(width).alias("numCols"),
        F.lit(None).cast("array<int>").alias("colPtrs"),
        F.lit(None).cast("array<int>").alias("rowIndices"),
        F.concat("values", F.array_repeat(F.lit(0.0), missing)).alias("values"),
        F.lit(True).alias("isTransposed"),
    )
    return grouped.select("block", matrix.alias("matrix"))


def matrix_of(path: str, spark: SparkSession, at: Column, rows: int, cols: int, shape: tuple[int, int]) -> BlockMatrix:
    """The written blocks at ``path`` as a matrix of ``shape``, each with its index ``at``."""
    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("matrix", MatrixUDT())])
    blocks = spark.read.schema(schema).parquet(path).select(at.cast(_INDEX).alias("_1"), F.col("matrix").alias("_2"))
    made = callMLlibFunc("createBlockMatrix", blocks, rows, cols, *shape)
    return BlockMatrix(made, rows, cols)


def scatter(path: str, spark: SparkSession, blocks: int, rows: int, width: int) -> np.ndarray:
    """The transpose of the written rows times the rows, the long side dealt over many tasks."""
    at = F.struct(F.col("block").alias("_1"), F.lit(0).alias("_2"))
    tall = matrix_of(path, spark, at, rows, width, (blocks * rows, width))
    splits = math.ceil(blocks / BLOCKS_PER_TASK)
    turned = tall.transpose()._java_matrix_wrapper
    product = turned.call("multiply", tall._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, width, width).toLocalMatrix().toArray()


def projected(path: str, spark: SparkSession, blocks: int, rows: int, weights: np.ndarray) -> str:
    """Where the written rows times ``weights`` are written, as blocks again."""
    width, told = weights.shape
    wide = math.ceil(math.sqrt(blocks))
    high = math.ceil(blocks / wide)
    column = F.floor(F.col("block") / high).cast("int")
    at = F.struct((F.col("block") % high).alias("_1"), column.alias("_2"))
    grid = matrix_of(path, spark, at, rows, width, (high * rows, wide * width))
    local = Matrices.dense(width, told, weights.ravel(order="F").tolist())
    diagonal = BlockMatrix(
        spark.sparkContext.parallelize([((s, s), local) for s in range(wide)]), width, told, wide * width, wide * told
    )
    product = grid.multiply(diagonal)
    found = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model)
    index = (F.col("_1._2") * high + F.col("_1._1")).cast("int")
    out = scratch_dir(spark, "white-projected")
    found.select(index.alias("block"), F.col("_2").alias("matrix")).write.parquet(out)
    return out


def _plain(path: str, spark: SparkSession) -> DataFrame:
    """Written matrices read as the plain values they are stored as."""
    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("matrix", MatrixUDT.sqlType())])
    return spark.read.schema(schema).parquet(path)


def out_of_blocks(path: str, spark: SparkSession, rows: int, told: int) -> DataFrame:
    """``rank`` and ``white`` of every row of the written blocks."""
    found = _plain(path, spark).select("block", "matrix.values", "matrix.isTransposed")
    places = F.sequence(F.lit(0), F.lit(rows - 1))
    across, down = (F.lit(told), F.lit(1)), (F.lit(1), F.lit(rows))

    def row(i: Column) -> Column:
        first = F.when(F.col("isTransposed"), i * across[0]).otherwise(i * down[0])
        step = F.when(F.col("isTransposed"), across[1]).otherwise(down[1])
        return F.array(*(F.get("values", first + step * k) for k in range(told)))

    each = found.select("block", F.posexplode(F.transform(places, row)).alias("at", "white"))
    return each.select((F.col("block").cast("long") * rows + F.col("at")).alias("rank"), "white")


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, ``most`` at most, that are told from 0, falling, and their unit vectors."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    least = max(values[0], 0.0) * len(values) * np.finfo(float).eps * 64
    told = min(most, int((values > least).sum()))
    return values[:told], vectors[:, :told]


_RESULT = {
    "component": "int",
    "n": "long",
    "deviation": "long",
    "whitened": "double",
    "explained": "double",
    "identity_error": "double",
}


def _of_one_length(rows: DataFrame, width: int, most: int) -> DataFrame | None:
    spark = rows.sparkSession
    fit = ranked(rows.select("x").distinct(), [F.col("x")], "white-fit")
    n, sums = column_sums(fit, width)
    per_block = max(BLOCK_ROWS, math.ceil(n / MOST_BLOCKS))
    blocks = math.ceil(n / per_block)
    path = scratch_dir(spark, "white-blocks")
    in_blocks(fit.select("rank", centred(n, sums).alias("row")), per_block, width).write.parquet(path)
    covariance = scatter(path, spark, blocks, per_block, width) / n
    values, vectors = components(covariance, most)
    if not len(values):
        return None
    white = projected(path, spark, blocks, per_block, vectors / np.sqrt(values))
    error = float(np.abs(scatter(white, spark, blocks, per_block, len(values)) / n - np.eye(len(values))).max())
    explained = (values / np.trace(covariance)).tolist()
    named = fit.select("rank", deviation(n, sums).alias("deviation"), *_name("x"))
    known = named.join(out_of_blocks(white, spark, per_block, len(values)), "rank").drop("rank")
    known = small_side(settled(known, "white-known"))
    met = rows.select("id", *_name("x")).join(known, ["h1", "h2"])
    each = met.select("id", "deviation", F.posexplode("white").alias("at", "whitened"))
    return each.select(
        "id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*map(F.lit, explained))[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS
) -> DataFrame:
    """Every vector on the ``most`` leading principal components of the distinct vectors, scaled to variance 1.

    One row per vector and component: ``id``, ``component`` (from 1, by falling
    eigenvalue), ``n`` (distinct vectors), ``deviation`` (sum of ``(n*x - S)**2``,
    null where that is no long), ``whitened``, ``explained`` (share of the variance)
    and ``identity_error`` (of the covariance of ``whitened`` over the fit).

    Rows whose vector is null, or has an entry that is null, not finite or no long
    after scaling, are left out.  Rows that repeat, null ids included, are each
    returned and counted once in the fit.  Vectors of different lengths are fitted
    apart; there may be ``MOST_LENGTHS`` lengths.  A component whose eigenvalue is 0
    to double precision cannot be whitened and is left out, so a single vector,
    equal vectors, empty vectors and an empty table give no rows.  Equal
    eigenvalues may share out their plane in any way, the same for all rows.  Other
    columns are not read.
    """
    x = whole(F.col(vector_col))
    rows = vectors.select(F.col(id_col).alias("id"), x.alias("x")).filter(F.col("x").isNotNull())
    rows = settled(rows, "white-rows")
    lengths = [r["w"] for r in rows.select(F.size("x").alias("w")).distinct().limit(MOST_LENGTHS + 1).collect()]
    if len(lengths) > MOST_LENGTHS:
        raise ValueError(f"vectors of more than {MOST_LENGTHS} lengths")
    none = [F.lit(None).cast(kind).alias(name) for name, kind in _RESULT.items()]
    result = rows.filter(F.lit(False)).select("id", *none)
    for width in sorted(w for w in lengths if w):
        found = _of_one_length(rows.filter(F.size("x") == width), width, most)
        result = result if found is None else result.unionByName(found)
    return result
