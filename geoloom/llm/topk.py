"""Exact top-k by inner product with pivot-table elimination.

Vectors become points whose distances order like inner products: the vectors x of a cell get one more
coordinate that lifts them to the cell's largest norm, a query gets a zero there, so
|q - x|^2 = |q|^2 + M - 2 q.x. The table holds the products of all points with ``PIVOTS`` pivots, hence their
distances to them. For a query and a cell the largest gap between the query's distance to a pivot and those of
the cell's points bounds the distance to all of them from below, and so their scores from above.

Points are sorted by the size of their norm and by the nearest pivot, cut into blocks of about ``POINT_BLOCK``
and, within a block, into cells of ``CELL``. Every query first meets the block it lies in, which gives it a
k-th score to beat. Blocks that cannot reach that score are left out by their bounds; in the others cells are
evaluated in the order of their bounds, several queries at a time, until the next bound is below the k-th
score of all of them. Every point is in the search; the pivots alone come from a sample.

Components become floor(scale * x) as integers. Scores are exact: a product of vectors is computed in float64
where the product of their norms is below 2**53, and in 64-bit integers beyond. Ties go to the smaller id.

Defined cases: vectors that are null, empty, or hold null or non-finite components, or have a null id, take
no part, nor do those whose squared norm is 2**63 or more (their scores need not fit a long); vectors of
another length than the query's are not compared; rows that repeat an id are one row of the result each, and
are no candidates of one another; fewer than k candidates give all of them; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm import common

PIVOTS = 32
#: Rows from which the pivots are chosen, by the smallest hashes of their ids.
SAMPLE = 2048
QUERY_BLOCK = 2048
POINT_BLOCK = 8192
#: Blocks are larger where there would be more of them: their bounds go to every task.
MOST_BLOCKS = 1 << 16
CELL = 128
#: Cells evaluated at once, between two looks at the k-th scores.
STRIDE = 16
EXACT = float(1 << 53)
#: Relative slack of computed distances, which carry rounding errors.
SLACK = 1e-7


def integers(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """id, integer components (array of long) and squared norm (double) of the vectors that take part."""
    raw = F.col(vector_column)
    whole = F.transform(raw, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = vectors.filter(F.col(id_column).isNotNull() & raw.isNotNull() & (F.size(raw) > 0) & finite)
    rows = held.select(F.col(id_column).cast("bigint").alias("id"), whole.alias("x"))
    rows = rows.withColumn("norm", F.aggregate("x", F.lit(0.0), lambda s, x: s + x * x)).filter(F.col("norm") < float(1 << 63))
    return rows.select("id", F.transform("x", lambda x: x.cast("bigint")).alias("v"), "norm", F.size("x").alias("size"))


def _pivots(points: DataFrame, total: int) -> dict[int, np.ndarray]:
    """By vector length: pivots far from one another, out of a bounded sample."""
    draw = F.xxhash64("id")
    share = min(1.0, 4 * SAMPLE / max(total, 1))  # tasks send few rows more than the sample has
    rows = points.filter(draw < int(((2 * share - 1) * (1 << 63)) if share < 1 else (1 << 63) - 1)).orderBy(draw, "id", "v").limit(SAMPLE)
    rows = rows.select("v").collect()
    chosen = {}
    for size in {len(r.v) for r in rows}:
        sample = np.array([r.v for r in rows if len(r.v) == size], np.float64)
        nearest, picked = np.full(len(sample), np.inf), [0]
        for _ in range(min(PIVOTS, len(sample)) - 1):
            nearest = np.minimum(nearest, ((sample - sample[picked[-1]]) ** 2).sum(axis=1))
            picked.append(int(nearest.argmax()))
        chosen[size] = sample[picked]
    return chosen


def matrix(column: pd.Series, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<i8").reshape(-1, size)


def best_scores(q: np.ndarray, low: np.ndarray, high: np.ndarray, top: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Bound from above on the scores of queries with the points of cells.

    ``low`` and ``high`` are the least and largest products of a cell's points with each pivot, ``top`` its
    largest squared norm.
    """
    square = (q * q).sum(axis=1)
    slack = SLACK * np.sqrt(np.maximum(square.max(initial=0.0), top.max(initial=0.0)) + (pivots**2).sum(axis=1).max(initial=0.0))
    nearest = np.zeros((len(q), len(top)))
    for j, p in enumerate(pivots):
        own = p @ p
        away = np.sqrt(np.maximum(square + own - 2 * (q @ p), 0.0))[:, None]
        near = np.sqrt(np.maximum(top + own - 2 * high[:, j], 0.0))
        far = np.sqrt(np.maximum(top + own - 2 * low[:, j], 0.0))
        np.maximum(nearest, np.maximum(away - far, near - away), out=nearest)
    nearest = np.maximum(nearest - slack, 0.0)
    by_pivots = (square[:, None] + top - nearest**2) / 2
    by_norms = np.sqrt(square)[:, None] * np.sqrt(top)
    return np.minimum(by_pivots, by_norms) + 1e-9 * (square[:, None] + top) + 1e-3


def products(q: np.ndarray, x: np.ndarray, square: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Exact scores as 64-bit integers, of matrices of 64-bit integers and their squared norms."""
    if len(q) and len(x) and np.sqrt(square.max()) * np.sqrt(norm.max()) < EXACT:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    out = np.empty((len(q), len(x)), np.int64)
    big_q, big_x = (np.flatnonzero(np.sqrt(s) * np.sqrt(other.max(initial=1.0)) >= EXACT) for s, other in ((square, norm), (norm, square)))
    small_q, small_x = np.setdiff1d(np.arange(len(q)), big_q), np.setdiff1d(np.arange(len(x)), big_x)
    # Sums that leave 64 bits on the way come back: the score itself fits.
    with np.errstate(over="ignore"):
        for i, j in ((big_q, np.arange(len(x))), (small_q, big_x)):
            out[np.ix_(i, j)] = q[i] @ x[j].T
    out[np.ix_(small_q, small_x)] = (q[small_q].astype(np.float64) @ x[small_x].astype(np.float64).T).astype(np.int64)
    return out


class Found:
    """The k best of every query so far, and the score that the next one must reach."""

    def __init__(self, ids: np.ndarray, k: int, least: np.ndarray):
        self.ids, self.k, self.least = ids, k, least.copy()
        self.rows = np.zeros((3, 0), np.int64)  # query, score, id

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        i, j = np.nonzero(scores >= self.least[queries][:, None])
        new = np.stack([queries[i], scores[i, j], ids[j]])
        new = new[:, self.ids[new[0]] != new[2]]
        if not new.shape[1]:
            return
        rows = np.concatenate([self.rows, new], axis=1)
        rows = rows[:, np.lexsort((rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], rows[0])
        rank = np.arange(rows.shape[1]) - first
        last = rank == self.k - 1
        self.least[rows[0, last]] = np.maximum(self.least[rows[0, last]], rows[1, last])
        self.rows = rows[:, rank < self.k]


def cells_of(x: np.ndarray, norm: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the cells, their least and largest products with the pivots and their largest squared norms."""
    starts = np.arange(0, len(x), CELL)
    table = x.astype(np.float64) @ pivots.T
    return starts, np.minimum.reduceat(table, starts), np.maximum.reduceat(table, starts), np.maximum.reduceat(norm, starts)


def search(queries: pd.DataFrame, points: pd.DataFrame, pivots: dict[int, np.ndarray], k: int) -> pd.DataFrame:
    """The k best points of each query (id, row, v, norm, least), as far as they reach its ``least`` score."""
    found = []
    for size, group in queries.groupby(queries["v"].map(len) // 8) if len(queries) else []:
        same = points[points["v"].map(len) == 8 * size]
        if not len(same):
            continue
        anchors = pivots.get(size, np.zeros((0, size)))
        x, norm, ids = matrix(same["v"], size), same["norm"].to_numpy(), same["id"].to_numpy()
        q, square = matrix(group["v"], size), group["norm"].to_numpy()
        starts, low, high, top = cells_of(x, norm, anchors)
        reach = best_scores(q.astype(np.float64), low, high, top, anchors)
        best = Found(group["id"].to_numpy(), k, group["least"].to_numpy())
        # Cells that some query expects most of come first.
        order = np.argsort(-reach.max(axis=0), kind="stable")
        for a in range(0, len(order), STRIDE):
            cells = order[a : a + STRIDE]
            open_ = reach[:, cells] >= best.least[:, None]
            if not open_.any():
                if (reach[:, order[a:]].max(axis=1) < best.least).all():
                    break
                continue
            cells = cells[open_.any(axis=0)]
            now = np.flatnonzero(open_.any(axis=1))
            at = np.concatenate([np.arange(s, min(s + CELL, len(x))) for s in starts[cells]])
            best.add(now, products(q[now], x[at], square[now], norm[at]), ids[at])
        number, score, vec_id = best.rows
        cells = {"query_id": group["id"].to_numpy()[number], "query_row": group["row"].to_numpy()[number], "vec_id": vec_id, "score": score}
        found.append(pd.DataFrame(cells))
    if not found:
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "query_row", "vec_id", "score")})
    return pd.concat(found)


def _placed(points: DataFrame, pivots) -> DataFrame:
    """The points with the keys by which blocks are cut: norm class, nearest pivot and the distance to it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame.assign(shell=np.frexp(frame["norm"].to_numpy())[1], nearest=0, away=0.0)
            for size, group in frame.groupby("size") if len(frame) else []:
                anchors = pivots.value.get(size)
                if anchors is not None:
                    x = np.stack(group["v"].to_numpy()).astype(np.float64)
                    square = ((anchors**2).sum(axis=1) - 2 * x @ anchors.T) + group["norm"].to_numpy()[:, None]
                    frame.loc[group.index, "nearest"] = square.argmin(axis=1)
                    frame.loc[group.index, "away"] = square.min(axis=1)
            frame["v"] = [np.asarray(v, "<i8").tobytes() for v in frame["v"]]
            yield frame[["id", "row", "v", "norm", "size", "shell", "nearest", "away"]]

    return points.mapInPandas(
        run, "id bigint, row bigint, v binary, norm double, size int, shell int, nearest int, away double"
    )


def _summaries(blocks: DataFrame, pivots) -> list[tuple]:
    """Bounds of every block and vector length: block, size, top, low, high. A few numbers a block reach the driver."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for (block, size), group in frame.groupby(["block", "size"]) if len(frame) else []:
                table = matrix(group["v"], size).astype(np.float64) @ pivots.value.get(size, np.zeros((0, size))).T
                rows.append((block, size, group["norm"].max(), table.min(axis=0), table.max(axis=0)))
            yield pd.DataFrame(rows, columns=["block", "size", "top", "low", "high"])

    parts = blocks.select("block", "size", "v", "norm").mapInPandas(
        run, "block int, size int, top double, low array<double>, high array<double>"
    )
    held: dict[tuple, tuple] = {}
    for r in parts.collect():
        low, high = np.array(r.low, np.float64), np.array(r.high, np.float64)
        top, least, most = held.get((r.block, r.size), (r.top, low, high))
        held[r.block, r.size] = max(top, r.top), np.minimum(least, low), np.maximum(most, high)
    return [(*key, *value) for key, value in held.items()]


def top_k(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 20,
    scale: int = 64,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best other rows of every query."""
    spark = vectors.sparkSession
    points = integers(vectors, id_column, vector_column, scale)
    total = points.count()
    pivots = spark.sparkContext.broadcast(_pivots(points, total))
    placed = common.stored(_placed(points.withColumn("row", F.monotonically_increasing_id()), pivots), "points")
    count = min(MOST_BLOCKS, max(1, -(-total // POINT_BLOCK)))
    order = ["size", "shell", "nearest", "away", "row"]
    blocks = placed.repartitionByRange(count, *order).sortWithinPartitions(*order)
    blocks = blocks.select(F.spark_partition_id().alias("block"), "id", "row", "v", "norm", "size")
    blocks = common.stored(blocks.withColumn("query", is_query(F.col("id"))), "blocks")
    summaries = spark.sparkContext.broadcast(_summaries(blocks, pivots))
    least = int(np.iinfo(np.int64).min)

    def first(frame: pd.DataFrame) -> pd.DataFrame:
        """The queries of a block with the k-th score they have in it."""
        asked = frame[frame["query"].fillna(False).astype(bool)].assign(least=least)
        found = search(asked, frame, pivots.value, k)
        kth = found.groupby("query_row")["score"].agg(lambda s: s.nsmallest(1).iloc[0] if len(s) >= k else least)
        asked["least"] = asked["row"].map(kth).fillna(least).astype("int64") if len(kth) else least
        return asked[["id", "row", "v", "norm", "least"]]

    fields = "id bigint, row bigint, v binary, norm double, least bigint"
    queries = common.stored(blocks.groupBy("block").applyInPandas(first, fields), "queries")
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def wanted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Every query with the blocks that may hold one of its k best."""
        by_size: dict[int, list] = {}
        for block, size, *bounds in summaries.value:
            by_size.setdefault(size, []).append((block, *bounds))
        for frame in frames:
            for size, group in frame.groupby(frame["v"].map(len) // 8) if len(frame) else []:
                numbers, top, low, high = (np.array(c) for c in zip(*by_size[size]))
                anchors = pivots.value.get(size, np.zeros((0, size)))
                for a in range(0, len(group), 256):
                    some = group.iloc[a : a + 256]
                    reach = best_scores(matrix(some["v"], size).astype(np.float64), low, high, top, anchors)
                    i, j = np.nonzero(reach >= some["least"].to_numpy()[:, None])
                    yield some.iloc[i].assign(block=numbers[j])[["block", "id", "row", "v", "norm", "least"]]

    asked = queries.mapInPandas(wanted, f"block int, {fields}")
    asked = asked.withColumn("qb", F.pmod(F.xxhash64("row"), F.lit(query_blocks)).cast("int"))
    parts = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb")
    others = blocks.select(parts, "block", "id", "v", "norm")
    schema = "query_id bigint, query_row bigint, vec_id bigint, score bigint"
    near = asked.groupBy("qb", "block").cogroup(others.groupBy("qb", "block")).applyInPandas(
        lambda q, p: search(q, p, pivots.value, k), schema
    )
    rank = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
