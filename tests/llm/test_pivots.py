import numpy as np
import pytest

from farelens.llm.common import stored_table
from farelens.llm.pivots import (
    SHARED,
    _forest,
    choose_pivots,
    near_duplicate_vectors,
    nearest_pivots,
)

SF = "/root/testdata/sf0.01/embeddings.parquet"
NAN, INF = float("nan"), float("inf")


def brute(rows, limit=0.93):
    """vec_id of each row, links of each row, smallest id reachable."""
    good = []
    for i, (_, e, label) in enumerate(rows):
        if e is None or label is None or any(x is None or not np.isfinite(x) for x in e) or not any(e):
            continue
        good.append(i)
    links = {i: set() for i in range(len(rows))}
    for a in good:
        for b in good:
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a < b and rows[a][2] == rows[b][2] and len(x) == len(y):
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= limit:
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for i in links:
        seen, queue = {i}, [i]
        while queue:
            for j in links[queue.pop()] - seen:
                seen.add(j)
                queue.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(links[i]), min(ids, default=None)))
    return sorted(out, key=str)


def found(df, **options):
    got = near_duplicate_vectors(df, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)


TYPE = "vec_id long, embedding array<float>, label int, component_id long, node int"


def test_odd_vectors(spark):
    x, y = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [
        (1, x, 1), (2, y, 1), (3, x, 1), (3, x, 1), (4, x, 2), (5, x, None), (6, None, 1), (7, [], 1),
        (8, [0.0, 0.0, 0.0], 1), (9, [1.0, None, 3.0], 1), (10, [NAN, 2.0, 3.0], 1),
        (11, [INF, 1.0, 1.0], 1), (None, y, 1), (12, [1.0, 2.0], 1), (13, [1.0, 2.0], 1),
        (14, [-1.0, 2.0, 3.0], 1), (None, [5.0], 9), (15, [1e-30, 2e-30, 3e-30], 1),
    ]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], TYPE)
    assert found(df) == brute(rows)
    assert found(df, block=2) == brute(rows)
    assert found(df.limit(0)) == []


def test_forest():
    rng = np.random.default_rng(1)
    for _ in range(20):
        m = rng.random((12, 12)) < 0.1
        m |= m.T
        np.fill_diagonal(m, False)
        edges = _forest(m)
        assert all(m[a, b] for a, b in edges)
        reach = np.linalg.matrix_power(m.astype(float) + np.eye(12), 12) > 0
        forest = np.eye(12)
        for a, b in edges:
            forest[a, b] = forest[b, a] = 1
        assert ((np.linalg.matrix_power(forest, 12) > 0) == reach).all()


@pytest.mark.parametrize("block", [3, 20, 2048])
def test_table(spark, block):
    """Whole lists, lists of two pivots and blocks of lists give the same links."""
    df = spark.read.parquet(SF)
    assert found(df, block=block) == brute([(r.vec_id, r.embedding, r.label) for r in df.collect()])


def test_recall_near_the_limit(spark):
    """Pairs just above the limit among unrelated vectors."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(600):
        x, z = rng.normal(size=(2, 64))
        x /= np.linalg.norm(x)
        z -= z @ x * x
        z /= np.linalg.norm(z)
        c = rng.uniform(0.931, 0.95)
        rows += [(2 * i, x.tolist(), 1), (2 * i + 1, (c * x + np.sqrt(1 - c * c) * z).tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = near_duplicate_vectors(df).filter("n_links = 1").count()
    assert got >= 0.97 * len(rows)


def cluster(rng, mean, count, pairs, size=64):
    """Unit vectors of a mean cosine with each other, the first of them in pairs just above the
    limit: rows 2 i and 2 i + 1."""

    def unit(m):
        return m / np.linalg.norm(m, axis=-1, keepdims=True)

    centre = np.sqrt(mean) * unit(rng.normal(size=size))
    free = unit(rng.normal(size=(count, size)))
    kept = (rng.uniform(0.931, 0.95, pairs) - mean) / (1 - mean)
    turned = unit(rng.normal(size=(pairs, size)))
    first = free[: 2 * pairs : 2]
    free[1 : 2 * pairs : 2] = unit(kept[:, None] * first + np.sqrt(1 - kept**2)[:, None] * turned)
    return unit(centre + np.sqrt(1 - mean) * free)


def vectors_table(spark, matrix):
    rows = [(i, v, 1) for i, v in enumerate(matrix.tolist())]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


@pytest.mark.parametrize("mean", [0.5, 0.8, 0.85])
def test_recall_of_the_index_in_dense_clusters(spark, mean):
    """50,000 vectors of a mean cosine, the query's own parameters: pairs that become candidates."""
    matrix = cluster(np.random.default_rng(11), mean, 50000, 500)
    nodes = stored_table(vectors_table(spark, matrix).withColumnRenamed("vec_id", "node"), "nodes")
    pivots = choose_pivots(nodes, len(matrix), 0.93)
    near = nearest_pivots(nodes.filter("node < 1000"), pivots, 0.93, 10, 1.0).collect()
    has = {r.node: set(r.pivots) for r in near}
    close = [i for i in range(0, 1000, 2) if matrix[i] @ matrix[i + 1] >= 0.93]
    both = [len(has[i] & has[i + 1]) >= SHARED for i in close]
    assert len(both) > 200 and np.mean(both) >= 0.97


@pytest.mark.parametrize("block", [100, 2048])
def test_links_in_a_dense_cluster(spark, block):
    matrix = cluster(np.random.default_rng(12), 0.85, 3000, 400)
    near = matrix @ matrix.T >= 0.93
    wanted = near.sum(axis=1) - 1
    got = near_duplicate_vectors(vectors_table(spark, matrix), block=block).collect()
    n = np.array([r.n_links for r in sorted(got)])
    assert (n <= wanted).all() and n.sum() >= 0.97 * wanted.sum()


def test_pivots_are_not_copies_of_each_other(spark):
    """Multiples of one vector are a third of the rows; they do not use up the pivots."""
    rng = np.random.default_rng(13)
    one, rest = rng.normal(size=16), rng.normal(size=(400, 16))
    matrix = np.concatenate([one * np.arange(1, 201)[:, None], rest])
    got = near_duplicate_vectors(vectors_table(spark, matrix)).collect()
    assert all(r.n_links >= 199 and r.component_id == 0 for r in got if r.vec_id < 200)
