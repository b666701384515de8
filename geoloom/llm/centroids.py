"""Centroid clustering of integer vectors with an incrementally kept table of dot products.

A vector's state is its components, its squared norm and its exact dot product with every centroid. When the
centroids move, a dot product changes by the products with those components of its centroid that changed, so
a round adds the nonzero changes only and then takes the smallest of |v|^2 - 2 v.c + |c|^2. All of it is in
integers, so the result does not depend on the order of rows or on how they are partitioned.

A round reads the state of the round before and writes its own to the shared folder; then the old one is
deleted. What reaches the driver is one sum per centroid and component.

Components become floor(scale * x). Distances go to the smaller centroid number where they are equal.

Defined cases: vectors of another length than ``size``, null vectors, those holding null or non-finite
components or components of 2**27 and more after scaling (their products would not fit a long), and rows
without an id take no part; rows that repeat an id are one vector each; fewer vectors than ``k`` give as many
centroids as vectors; a centroid that loses all its vectors stays where it is; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom import session
from geoloom.llm import common

LARGEST = 1 << 27
#: Sums of products below this are exact in float64, where matrix products are fast.
EXACT = 1 << 53
STATE = "vec_id bigint, v binary, norm bigint, dots binary, cluster int, distance bigint"


def integers(vectors: DataFrame, id_column: str, vector_column: str, size: int, scale: int) -> DataFrame:
    """vec_id and components (array of long) of the vectors that take part."""
    raw = F.col(vector_column)
    limit = LARGEST / scale
    whole = F.transform(raw, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    held = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < limit))
    return vectors.filter(F.col(id_column).isNotNull() & (F.size(raw) == size) & held).select(
        F.col(id_column).cast("bigint").alias("vec_id"), whole.alias("v")
    )


def matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    """Rows of a binary column as a matrix."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros((0, width), dtype)
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return flat.view(dtype).reshape(len(column), width)


def binaries(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as a binary column."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    bounds = pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, bounds, pa.py_buffer(rows.tobytes())])


def _start(points: DataFrame, k: int, size: int) -> DataFrame:
    """The state before the first round: no centroid has moved from zero, so all dot products are zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)
            n = batch.num_rows
            arrays = [
                batch.column("vec_id"),
                binaries(v.astype("<i4")),
                pa.array((v * v).sum(axis=1)),
                binaries(np.zeros((n, k), "<i8")),
                pa.array(np.zeros(n, np.int32)),
                pa.array(np.zeros(n, np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "v", "norm", "dots", "cluster", "distance"])

    return points.mapInArrow(run, STATE)


def advance(dots: np.ndarray, v: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Dot products after every centroid moved by its row of ``change``."""
    dots = dots.copy()
    reach = int(np.abs(v).max(initial=0)) * int(np.abs(change).max(initial=0)) * max(v.shape[1], 1)
    kind = np.float64 if reach < EXACT else np.int64
    x = v.astype(kind)
    for j, row in enumerate(change):
        moved = np.flatnonzero(row)
        if len(moved):
            dots[:, j] += (x[:, moved] @ row[moved].astype(kind)).astype(np.int64)
    return dots


def _round(state: DataFrame, change: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """The state after the centroids moved by ``change`` to where they are now."""
    k, size = centroids.shape
    squares = (centroids * centroids).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), "<i4", size)
            dots = advance(matrix(batch.column("dots"), "<i8", k), v, change)
            away = batch.column("norm").to_numpy()[:, None] - 2 * dots + squares
            cluster = away.argmin(axis=1)
            arrays = [
                batch.column("vec_id"),
                batch.column("v"),
                batch.column("norm"),
                binaries(dots),
                pa.array(cluster.astype(np.int32)),
                pa.array(away[np.arange(len(v)), cluster]),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "v", "norm", "dots", "cluster", "distance"])

    return state.mapInArrow(run, STATE)


def _sums(state: DataFrame, k: int, size: int) -> tuple[np.ndarray, list[list[int]]]:
    """Vectors of every cluster and the sums of their components: k * size rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            v, cluster = matrix(batch.column("v"), "<i4", size), batch.column("cluster").to_numpy()
            counts += np.bincount(cluster, minlength=k)
            for j in np.unique(cluster):
                sums[j] += v[cluster == j].sum(axis=0, dtype=np.int64)
        arrays = [np.repeat(np.arange(k), size), np.tile(np.arange(size), k), np.repeat(counts, size), sums.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["cluster", "i", "n", "total"])

    parts = state.select("v", "cluster").mapInArrow(run, "cluster bigint, i bigint, n bigint, total bigint")
    counts, sums = np.zeros(k, np.int64), [[0] * size for _ in range(k)]
    for r in parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        counts[r.cluster] = r.n
        sums[r.cluster][r.i] = r.total
    return counts, sums


def seeds(points: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes, in the order of the hashes."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.v) for r in points.orderBy(order, "v").limit(k).collect()]


def digest(centroid) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def cluster(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 8,
    rounds: int = 10,
    size: int = 64,
    scale: int = 1024,
    salt: str = "3",
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster and squared distance of every vector that takes part, and the final centroids."""
    spark = vectors.sparkSession
    points = session.spread(integers(vectors, id_column, vector_column, size, scale))
    path = session.new_path(spark, "points")
    points.write.parquet(path)
    points = spark.read.schema(points.schema).parquet(path)
    centroids = np.array(seeds(points, k, salt), np.int64).reshape(-1, size)
    if not len(centroids):
        return points.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), centroids
    state, before = _start(points, len(centroids), size), np.zeros_like(centroids)
    for number in range(rounds + 1):
        new = session.new_path(spark, f"state-{number}")
        state = _round(state, centroids - before, centroids)
        schema = state.schema
        state.write.parquet(new)
        session.discard(spark, path)
        state, path = spark.read.schema(schema).parquet(new), new
        if number == rounds:
            break
        before = centroids
        counts, sums = _sums(state, *centroids.shape)
        moved = [[s // int(n) for s in row] if n else list(c) for n, row, c in zip(counts, sums, centroids)]
        centroids = np.array(moved, np.int64)
        if np.array_equal(centroids, before):
            break  # every further round would assign and move alike
    return state.select("vec_id", "cluster", "distance"), centroids


def clusters(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector."""
    rows, centroids = cluster(vectors, **options)
    inertia = {r.cluster: r.total for r in rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    number = F.col("cluster")
    own, mark = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    for j, centroid in enumerate(centroids):
        own = F.when(number == j, F.lit(inertia.get(j, 0)).cast("bigint")).otherwise(own)
        mark = F.when(number == j, F.lit(digest(centroid))).otherwise(mark)
    return rows.select(
        "vec_id",
        "cluster",
        "distance",
        own.alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        mark.alias("centroid_sha256"),
    )
