"""Near-duplicate vectors by a pivot-permutation index.

Reference points, the pivots, are vectors of the table itself: at most ``MOST_PIVOTS``, twice the
root of the number of vectors below that, so lists stay short and the pivots stay small enough to
broadcast; of pivots that are near-duplicates one is used. Each vector is described by its nearest
pivots in order: the ``depth`` nearest, and all that a vector at the limit may be as near to as to
the second nearest. Such a vector is the given one turned by a fixed angle in an unknown direction, which
changes each cosine by a normal deviate of known spread, and ``reach`` of these deviates below
the second nearest is where the description ends. So it is short where vectors are spread out
and longer in dense clusters, where the order of the pivots says less.

An inverted list per label and pivot holds the vectors that have the pivot among theirs; two
vectors of a list are candidates if they share at least ``SHARED`` pivots, and links if their
cosine reaches the limit. Equal vectors are one before all this, with their number. A pair is
looked at only in the list of its first shared pivot, so links can be counted without ever listing
them: a list gives each of its vectors a count and a spanning forest of its links. Lists longer
than ``block`` are cut into blocks, and every two blocks meet in a group of their own. Where that
would copy vectors more often than they have pivots to split by, a list is first split by a second
pivot, as candidates share two: then only candidates meet.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import batch_of, group_arrow, map_arrow, stored_table, table_of
from farelens.llm.components import connected_components
from farelens.llm.vectors import by_dimension, matrices, usable

MOST_PIVOTS = 4096
#: Pivots that candidates share; splitting a list by a second pivot rests on it.
SHARED = 2
NEAREST = pa.schema([("node", pa.int64()), ("pivots", pa.list_(pa.int32()))])
FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length 1, scaled first so that squares neither vanish nor overflow."""
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def choose_pivots(nodes: DataFrame, count: int, cosine: float) -> dict[int, np.ndarray]:
    """Vectors in an order that has nothing to do with their place, for each dimension; none that
    an earlier one is a near-duplicate of."""
    wanted = min(MOST_PIVOTS, max(32, 2 * math.isqrt(count)))
    sample = nodes.orderBy(F.xxhash64("embedding"), "node").limit(wanted)
    chosen = {}
    for size, matrix in matrices(sample).items():
        points = unit(matrix)
        chosen[size] = points[~(np.tril(points @ points.T, -1) >= cosine).any(axis=1)]
    return chosen


def deviation(points: np.ndarray, cosine: float) -> float:
    """How far the cosine to a pivot moves, over its sine, when a vector turns to the limit.

    The turn goes anywhere in the directions in which the pivots differ, whose number is that of
    equal eigenvalues with the same spread (corrected for what so few pivots can show)."""
    apart = points - points.mean(axis=0)
    scatter = apart.T @ apart
    share = (scatter * scatter).sum() / max(np.trace(scatter) ** 2, 1e-300) - 1 / len(points)
    directions = 1 / max(share, 1 / points.shape[1])
    return math.sqrt(1 - cosine**2) / cosine / math.sqrt(max(directions - 1, 1))


def nearest_pivots(
    nodes: DataFrame, pivots: dict[int, np.ndarray], cosine: float, depth: int, reach: float
) -> DataFrame:
    """(node, pivots): the nearest pivots in order. A dimension without pivots shares one list."""
    spread = {size: reach * deviation(points, cosine) for size, points in pivots.items()}

    def described(vectors, points, step):
        near = unit(vectors) @ points.T
        best = -np.partition(-near, [min(1, len(points) - 1), min(depth, len(points)) - 1], axis=1)
        second, last = best[:, min(1, len(points) - 1)], best[:, min(depth, len(points)) - 1]
        end = np.minimum(last, second - step * np.sqrt(np.maximum(1 - second * second, 0)))
        rows, columns = np.nonzero(near >= end[:, None])
        order = np.lexsort((columns, -near[rows, columns], rows))
        ends = np.cumsum(np.bincount(rows, minlength=len(vectors)))[:-1]
        return np.split(columns[order].astype(np.int32), ends)

    def run(batches):
        for batch in batches:
            names = batch.column("node").to_numpy()
            for size, rows, matrix in by_dimension(batch):
                points, step = pivots.get(size, np.ones((1, size))), spread.get(size, 0.0)
                for at in range(0, len(rows), 1024):
                    found = described(matrix[at : at + 1024], points, step)
                    yield batch_of({"node": names[rows[at : at + 1024]], "pivots": found}, NEAREST)

    return map_arrow(nodes.select("node", "embedding"), run, "node long, pivots array<int>")


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what a symmetric boolean matrix connects."""
    left, edges = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if not left[root]:
            continue
        left[root], queue = False, [root]
        while queue:
            node = queue.pop()
            reached = np.flatnonzero(linked[node] & left)
            left[reached] = False
            edges += [(node, int(r)) for r in reached]
            queue += reached.tolist()
    return edges


def _shared_first(near, pivot: int, second: int, shared: int, pairs: int = 1 << 14):
    """A function of two arrays of rows: whether they share enough pivots, none of them before
    ``pivot``, nor, in a list split by a second pivot, between the two."""
    sizes = np.fromiter(map(len, near), np.int64, len(near))
    high, at = np.unique(np.concatenate(near), return_inverse=True)
    has = np.zeros((len(near), len(high)), bool)
    has[np.repeat(np.arange(len(near)), sizes), at] = True
    before = (high < max(pivot, second)) & (high != pivot)
    bits = np.packbits(has, axis=1)
    earlier = np.packbits(has & before, axis=1)

    def right(i, j):
        out = np.empty(len(i), bool)
        for k in range(0, len(i), pairs):
            a, b = i[k : k + pairs], j[k : k + pairs]
            common = np.bitwise_count(bits[a] & bits[b]).sum(axis=1, dtype=np.int32)
            enough = common >= np.minimum(shared, np.minimum(sizes[a], sizes[b]))
            out[k : k + pairs] = enough & ~(earlier[a] & earlier[b]).any(axis=1)
        return out

    return right


def _list_links(limit: float, shared: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node").combine_chunks()
        batch = table.to_batches()[0]
        nodes, copies = batch.column("node").to_numpy(), batch.column("copies").to_numpy()
        pivot, second, low, high = (
            batch.column(c)[0].as_py() for c in ("pivot", "second", "low", "high")
        )
        part, m = batch.column("part").to_numpy(), len(nodes)
        left, right = np.flatnonzero(part == low), np.flatnonzero(part == high)
        _, _, matrix = next(by_dimension(batch))
        matrix = unit(matrix)
        close = matrix[left] @ matrix[right].T >= limit
        i, j = np.nonzero(np.triu(close, 1) if low == high else close)
        i, j = left[i], right[j]
        near = batch.column("pivots").to_numpy(zero_copy_only=False)
        good = _shared_first(near, pivot, second, shared)(i, j)
        i, j = i[good], j[good]
        counts = np.zeros(m, np.int64)
        np.add.at(counts, i, copies[j])
        np.add.at(counts, j, copies[i])
        linked = np.zeros((m, m), bool)
        linked[i, j] = linked[j, i] = True
        some, edges = np.flatnonzero(counts), _forest(linked)
        a = np.concatenate([nodes[some], nodes[[e[0] for e in edges]]]).astype(np.int64)
        b = np.concatenate([nodes[some], nodes[[e[1] for e in edges]]]).astype(np.int64)
        n = np.concatenate([counts[some], np.zeros(len(edges), np.int64)])
        return table_of({"a": a, "b": b, "n": n}, FOUND)

    return run


def list_groups(near: DataFrame, block: int) -> DataFrame:
    """A row per vector and group it is compared in: the list of a pivot, or of two pivots where
    that copies less than blocks do, and two blocks of it where that is longer than ``block``."""
    lists = near.withColumn("pivot", F.explode("pivots"))
    key = ["label", "size", "pivot"]
    long = lists.groupBy(*key).agg(
        F.count("node").alias("length"), F.avg(F.size("pivots")).alias("depth")
    ).filter(F.col("length") > block * F.greatest(F.lit(1.0), F.col("depth") / 2))
    long = stored_table(long.select(*key, F.lit(True).alias("long")), "long_lists")
    further = F.filter("pivots", lambda p: p > F.col("pivot"))
    split = F.col("long").isNotNull() & (F.size("pivots") > 1)
    lists = lists.join(long, key, "left")
    lists = lists.withColumn("second", F.explode(F.when(split, further).otherwise(F.array(F.lit(-1)))))
    key += ["second"]
    parts = lists.groupBy(*key).agg(F.count("node").alias("length")).filter(F.col("length") > block)
    parts = parts.select(*key, F.ceil(F.col("length") / block).cast("int").alias("parts"))
    lists = lists.join(stored_table(parts, "long_lists"), key, "left").fillna(1, ["parts"])
    lists = lists.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    lists = lists.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    lists = lists.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
    return lists.withColumn("group", F.struct(*key, "low", "high"))


def near_duplicate_vectors(
    embeddings: DataFrame,
    cosine: float = 0.93,
    depth: int = 10,
    reach: float = 1.0,
    block: int = 2048,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null and their cosine is at least ``cosine``.
    Rows with a null label, and vectors that are null, empty, zero or hold null or non-finite
    components, link with nothing, as do vectors of different dimensions. Repeated rows are
    vectors of their own. component_id is the smallest vec_id reachable, its own included; null
    ids count as largest. An empty table gives no rows. All links found are right; ``reach`` is how
    many deviations of a turn to the limit the index allows for (see the README for recall).
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long"), "embedding", "label"
    )
    rows = rows.withColumn("embedding", F.when(usable(F.col("embedding")) & F.col("label").isNotNull(), F.col("embedding")))
    classes = rows.filter("embedding is not null").groupBy("label", "embedding")
    classes = classes.agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    classes = stored_table(
        classes.withColumn("node", F.monotonically_increasing_id()), "vector_classes"
    )
    pivots = choose_pivots(classes, classes.count(), cosine)
    near = classes.join(nearest_pivots(classes, pivots, cosine, depth, reach), "node")
    near = near.select("node", "copies", "label", "embedding", "pivots", F.size("embedding").alias("size"))
    groups = list_groups(stored_table(near, "nearest_pivots"), block).select(
        "group", "node", "copies", "embedding", "pivots", "pivot", "second", "part", "low", "high"
    )
    found = group_arrow(groups, "group", _list_links(cosine, SHARED), "a long, b long, n long")
    found = stored_table(found, "vector_links")
    counts = found.filter("n > 0").groupBy("a").agg(F.sum("n").alias("n"))
    groups = connected_components(found.filter("a <> b").select("a", "b"))
    named = classes.select("node", "first_id", "copies").join(
        groups, "node", "left"
    ).withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(least, "component").join(counts.withColumnRenamed("a", "node"), "node", "left")
    named = stored_table(
        named.select("node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
        "named_classes",
    )
    named = classes.select("label", "embedding", "node").join(named, "node").drop("node")
    alone = rows.filter("embedding is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    linked = rows.filter("embedding is not null").join(named, ["label", "embedding"])
    return linked.select("vec_id", "n_links", "component_id").union(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
