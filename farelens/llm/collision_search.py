"""Nearest neighbours by query-aware collision counting.

A vector is hashed by one-dimensional projections, each kept as a sorted array. A query looks at
the window around its own projection in each array; a vector that lies in the window of a
projection collides there. Virtual rehashing widens the windows by a factor from radius to
radius, so the same arrays serve every radius and only the new ends of a window are counted.
Vectors that collide in at least ``threshold`` of the projections are verified: their distance
is computed in double precision. A query is done when its k-th distance lies within the radius
that has been covered, or when nothing is left.

At distance r a projection differs by a normal deviate of spread r, so with windows of half
width r a vector within the radius collides in 68 % of the projections at least; a threshold of
half of 48 misses one in several hundred. Blocks of vectors are indexed where they are read, and
what a query has found so far bounds its search in later blocks. Queries come in blocks too:
each is a matrix of at most ``query_block`` rows, sent to all tasks, and one pass over the table.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelens.llm.common import batch_of, map_arrow
from farelens.llm.vectors import by_dimension, usable

FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


class Block:
    """Sorted projections of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, axes: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.axes, self.projected = axes, vectors @ axes
        self.order = np.argsort(self.projected, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.take_along_axis(self.projected, self.order.T, axis=0).T.copy()

    def search(self, query: np.ndarray, own: int, best: list, k: int, threshold: int,
               first: float, factor: float) -> list:
        """``best`` and the vectors of this block: the k nearest as (score, vec_id), sorted."""
        centre, n = query @ self.axes, len(self.ids)
        counts = np.zeros(n, np.int32)
        open_ = self.ids != own
        low = np.fromiter((np.searchsorted(s, c) for s, c in zip(self.sorted, centre)), np.int64)
        high, radius = low.copy(), first
        while True:
            reach = best[-1][0] if len(best) == k else np.inf
            radius = min(radius, max(reach, first))
            gained = []
            for axis, (values, c) in enumerate(zip(self.sorted, centre)):
                begin = np.searchsorted(values, c - radius)
                end = np.searchsorted(values, c + radius, "right")
                begin, end = min(begin, low[axis]), max(end, high[axis])
                gained += [self.order[axis, begin : low[axis]], self.order[axis, high[axis] : end]]
                low[axis], high[axis] = begin, end
            counts += np.bincount(np.concatenate(gained), minlength=n).astype(np.int32)
            rows = np.flatnonzero(open_ & (counts >= threshold))
            if len(rows):
                open_[rows] = False
                gap = self.vectors[rows] - query
                scores = np.sqrt((gap * gap).sum(axis=1))
                near = np.lexsort((self.ids[rows], scores))[:k]
                own_best = zip(scores[near].tolist(), self.ids[rows[near]].tolist())
                best = sorted([*best, *own_best])[:k]
            covered = len(best) == k and best[-1][0] <= radius
            if covered or not open_.any() or (high - low).min() == n:
                return best
            radius *= factor


def search_queries(
    vectors: DataFrame, queries: DataFrame, k: int, axes_count: int, threshold: int,
    factor: float, block: int, seed: int,
) -> DataFrame:
    """The k nearest of each task for each query of one block."""
    matrix: dict[int, tuple] = {}
    for batch in queries.toArrow().to_batches():
        for size, rows, part in by_dimension(batch):
            ids = batch.column("vec_id").to_numpy()[rows]
            old = matrix.get(size, (np.empty(0, np.int64), np.empty((0, size))))
            matrix[size] = np.concatenate([old[0], ids]), np.concatenate([old[1], part])
    shared = vectors.sparkSession.sparkContext.broadcast(matrix)

    def run(batches):
        found: dict[int, list] = {}
        waiting: dict[int, list] = {}

        def index(size):
            ids = np.concatenate([w[0] for w in waiting[size]])
            rows = np.concatenate([w[1] for w in waiting.pop(size)])
            axes = np.random.default_rng(seed).normal(size=(size, axes_count))
            part = Block(ids, rows, axes)
            middle = rows.mean(axis=0)
            first = 0.2 * float(np.sqrt(((rows - middle) ** 2).sum(axis=1).mean())) or 1e-12
            for query, vector in zip(*shared.value[size]):
                best = found.get(int(query), [])
                found[int(query)] = part.search(
                    vector, query, best, k, threshold, first, factor
                )

        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            for size, rows, part in by_dimension(batch):
                if size in shared.value:
                    for at in range(0, len(rows), block):
                        waiting.setdefault(size, []).append((ids[rows[at : at + block]], part[at : at + block]))
                        if sum(len(w[0]) for w in waiting[size]) >= block:
                            index(size)
        for size in list(waiting):
            index(size)
        flat = [(q, v, s) for q, best in found.items() for s, v in best]
        columns = zip(*flat) if flat else ([], [], [])
        yield batch_of(dict(zip(FOUND.names, map(list, columns))), FOUND)

    return map_arrow(vectors, run, "query_id long, vec_id long, score double")


def nearest_neighbours(
    embeddings: DataFrame,
    every: int = 100,
    k: int = 10,
    axes: int = 48,
    threshold: int = 24,
    factor: float = 1.5,
    block: int = 8192,
    query_block: int = 16384,
    seed: int = 5,
) -> DataFrame:
    """query_id, rank from 1, vec_id, score: the k nearest found for each query, nearest first.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are all rows with
    another id and the same dimension. Rows with a null id, and vectors that are null, empty,
    zero or hold null or non-finite components, take no part. Ties go to the smaller vec_id;
    repeated rows are candidates each, and of repeated query ids the smallest vector asks. An
    empty table gives no rows.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    ).filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    queries = rows.filter(F.col("vec_id") % every == 0)
    queries = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    blocks = max(1, -(-queries.count() // query_block))
    number = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    found = None
    for n in range(blocks):
        part = search_queries(
            rows, queries.filter(number == n), k, axes, threshold, factor, block, seed
        )
        found = part if found is None else found.union(part)
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
