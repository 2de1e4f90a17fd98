"""Centroid clustering on bit planes: exact dot products from AND and popcount.

A vector's 64 components become integers.  Bit b of all of them is one 64-bit
word, its plane b; in two's complement the last plane weighs ``-2**b``.  The dot
product of two vectors is then the sum over pairs of planes of weight times
``popcount(a & b)``, and the squared distance ``x.x - 2 x.c + c.c``; arithmetic
modulo 2^64 is exact as long as the distance itself fits.  Planes are packed once
and written; every round reads them, assigns each vector to its nearest centroid
and counts, per cluster and plane, how many vectors have each bit.  Those counts,
a few rows per task, give the exact sums of which the new centroids are floors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.plans.sizing import settled

COMPONENTS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = "3"

# Vectors whose pairs of planes are counted at a time.
GROUP = 4096
_U = np.uint64
Centroids = list[tuple[int, ...]]


def weights(planes: int) -> np.ndarray:
    """What a bit of each plane counts, modulo 2^64; the last is the sign."""
    found = [(1 << b) for b in range(planes)]
    found[-1] = -found[-1]
    return np.array([w % (1 << 64) for w in found], _U)


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """Rows of 64 integers as rows of ``planes`` words."""
    bits = np.empty((len(values), planes, COMPONENTS), np.uint8)
    for b in range(planes):
        bits[:, b] = (values >> b) & 1
    return np.packbits(bits, axis=2, bitorder="little").view(_U)[:, :, 0]


def dots(words: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Dot product of every row of planes with one vector's planes, modulo 2^64."""
    weight = weights(len(other))
    common = np.bitwise_count(words[:, :, None] & other[None, None, :]).astype(_U)
    return (common * (weight[:, None] * weight[None, :])).sum(axis=(1, 2), dtype=_U)


def self_dots(words: np.ndarray) -> np.ndarray:
    weight = weights(words.shape[1])
    total = np.zeros(len(words), _U)
    for b in range(words.shape[1]):
        common = np.bitwise_count(words & words[:, b : b + 1]).astype(_U)
        total += (common * (weight * weight[b])).sum(axis=1, dtype=_U)
    return total


def nearest(words: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every row of planes the nearest centroid (the smaller number at ties) and its squared distance."""
    own = self_dots(words)
    apart = np.empty((len(words), len(centroids)), np.int64)
    for k, (planes, norm) in enumerate(zip(centroids, self_dots(centroids), strict=True)):
        apart[:, k] = (own - _U(2) * dots(words, planes) + norm).astype(np.int64)
    cluster = apart.argmin(axis=1)
    return cluster, apart[np.arange(len(words)), cluster]


def _words(column: pa.Array, planes: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).view(_U).reshape(len(column), planes)


def _packed(planes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, COMPONENTS)
            words = pack(values, planes).view(np.int64).ravel()
            at = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * planes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(at, pa.array(words))], ["id", "planes"]
            )

    return run


def _counted(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters, planes = centroids.shape
        ones = np.zeros((clusters, planes, COMPONENTS), np.int64)
        size = np.zeros(clusters, np.int64)
        for batch in batches:
            words = _words(batch.column("planes"), planes)
            for first in range(0, len(words), GROUP):
                some = words[first : first + GROUP]
                cluster, _ = nearest(some, centroids)
                for k in np.unique(cluster).tolist():
                    own = np.ascontiguousarray(some[cluster == k])
                    bits = np.unpackbits(own.view(np.uint8), axis=1, bitorder="little")
                    ones[k] += bits.sum(axis=0, dtype=np.int64).reshape(planes, COMPONENTS)
                    size[k] += len(own)
        for k in np.flatnonzero(size).tolist():
            yield pa.RecordBatch.from_pydict(
                {
                    "cluster": pa.array([k] * planes, pa.int32()),
                    "plane": pa.array(range(planes), pa.int32()),
                    "vectors": pa.array([int(size[k])] * planes, pa.int64()),
                    "ones": pa.array(ones[k].tolist(), pa.list_(pa.int64())),
                }
            )

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _words(batch.column("planes"), centroids.shape[1])
            for first in range(0, len(words), GROUP):
                cluster, distance = nearest(words[first : first + GROUP], centroids)
                found = [pa.array(cluster.astype(np.int32)), pa.array(distance)]
                ids = batch.column("id").slice(first, len(cluster))
                yield pa.RecordBatch.from_arrays([ids, *found], ["id", "cluster", "distance"])

    return run


def integers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``x``, the floors of ``SCALE`` times the components, of the vectors that take part."""
    usable = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform(vector_col, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")))
    rows = vectors.filter((F.size(vector_col) == COMPONENTS) & usable)
    return rows.select(F.col(id_col).alias("id"), whole.cast("array<bigint>").alias("x"))


def planes_needed(rows: DataFrame) -> int:
    """Bits of the widest component.  Distances must fit a long, so the box of all vectors may not be wider."""
    ends = [F.struct(F.min(F.col("x")[j]).alias("lo"), F.max(F.col("x")[j]).alias("hi")) for j in range(COMPONENTS)]
    box = rows.agg(F.array(*ends).alias("box")).first()["box"]
    if box[0]["lo"] is None:
        return 1
    if sum((side["hi"] - side["lo"]) ** 2 for side in box) >= 1 << 63:
        raise ValueError("squared distances between these vectors do not fit a long")
    return 1 + max(max(side["hi"], -side["lo"] - 1, 0).bit_length() for side in box)


def moved(packed: DataFrame, centroids: Centroids, planes: int) -> Centroids:
    """Every non-empty cluster's exact floor of the mean; empty ones stay."""
    words = pack(np.array(centroids, np.int64), planes)
    counted = packed.select("planes").mapInArrow(
        _counted(words), "cluster int, plane int, vectors long, ones array<long>"
    )
    sums = F.array(*(F.sum(F.col("ones")[j]) for j in range(COMPONENTS)))
    found = counted.groupBy("cluster", "plane").agg(F.sum("vectors").alias("vectors"), sums.alias("ones")).collect()
    after = list(centroids)
    for k in {r["cluster"] for r in found}:
        own = [r for r in found if r["cluster"] == k]
        sign = planes - 1
        totals = [
            sum(r["ones"][j] * ((1 << r["plane"]) if r["plane"] != sign else -(1 << sign)) for r in own)
            for j in range(COMPONENTS)
        ]
        after[k] = tuple(total // own[0]["vectors"] for total in totals)
    return after


def first_centroids(rows: DataFrame, clusters: int, seed: str) -> Centroids:
    """The vectors with the least sha256 of ``<seed>:<id>``; of one id, the least components first."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    chosen = rows.select("x", F.sha2(name, 256).alias("turn")).orderBy("turn", "x").limit(clusters).collect()
    return [tuple(r["x"]) for r in chosen]


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: str = SEED,
) -> DataFrame:
    """Every vector that takes part with its cluster after ``rounds`` rounds.

    Columns: ``id``, ``cluster``, ``distance`` (squared), ``cluster_inertia`` and
    ``inertia`` (distances summed over the cluster and over all; null where the sum
    is no long), ``centroid_sha256`` (of the final centroid's components, joined
    by commas).

    Vectors that are null, have other than 64 components, or a null or non-finite
    one, take no part.  Rows that repeat are each a vector, and may be two of the
    first centroids; those of a null id are named by the empty string.  With fewer
    vectors than ``clusters`` there are as many centroids as vectors; an empty table
    gives no rows.  Vectors so far apart that a squared distance is no long raise
    ``ValueError``.  Only centroids and counts of bits, ``clusters`` times 64 times
    the number of planes, reach the driver; no other column is read.
    """
    rows = settled(integers(vectors, id_col, vector_col), "centroid-rows")
    planes = planes_needed(rows)
    id_type = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("planes", T.ArrayType(T.LongType()))])
    packed = settled(rows.mapInArrow(_packed(planes), schema), "centroid-planes")
    centroids = first_centroids(rows, clusters, seed)
    if not centroids:
        centroids = [(0,) * COMPONENTS]
    for _ in range(rounds):
        centroids, before = moved(packed, centroids, planes), centroids
        if centroids == before:
            break
    schema = T.StructType(
        [T.StructField("id", id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    )
    words = pack(np.array(centroids, np.int64), planes)
    found = settled(packed.mapInArrow(_assigned(words), schema), "centroid-found")
    each = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()
    totals = {r["cluster"]: int(r["sum"]) for r in each}
    model = [
        (
            k,
            _long(totals.get(k, 0)),
            _long(sum(totals.values())),
            hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest(),
        )
        for k, centroid in enumerate(centroids)
    ]
    names = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # As many rows as there are clusters.
    told = F.broadcast(found.sparkSession.createDataFrame(model, names))
    return found.join(told, "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None
