import numpy as np
import pytest

from farelens.llm.collision_search import nearest_neighbours

NAN, INF = float("nan"), float("inf")


def brute(rows, k=10):
    good = [
        (i, np.array(e, float))
        for i, e in rows
        if i is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)
    ]
    queries = {}
    for i, e in sorted(good, key=lambda r: (r[0], r[1].tolist())):
        if i % 100 == 0:
            queries.setdefault(i, e)
    out = {}
    for q, x in queries.items():
        near = [(float(np.sqrt(((e - x) ** 2).sum())), i) for i, e in good if i != q and len(e) == len(x)]
        out[q] = [(i, s) for s, i in sorted(near)[:k]]
    return {q: n for q, n in out.items() if n}


def found(df, **options):
    out = {}
    for r in sorted(nearest_neighbours(df, **options).collect()):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_odd_vectors(spark):
    x = [1.0, 2.0, 3.0]
    rows = [
        (0, x), (100, x), (1, x), (1, x), (2, [1.0, 2.0, 4.0]), (300, None), (4, None), (5, []),
        (400, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]), (7, [NAN, 1.0, 1.0]), (8, [INF, 1.0, 1.0]),
        (None, x), (9, [1.0, 2.0]), (500, [1.0, 5.0]), (600, [7.0]), (700, [2.0, 2.0, 2.0]), (700, x),
        (-100, [9.0, 9.0, 9.0]),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    assert found(df) == brute(rows)
    assert found(df, query_block=2, block=3) == brute(rows)
    assert found(df.limit(0)) == {}


def test_many_copies(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(500 + i, [1.0, float(i), 3.0]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert found(df, block=100) == brute(rows)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    expected = brute([(r.vec_id, r.embedding) for r in df.collect()])
    got = found(df, block=512)
    assert set(got) == set(expected)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.98 * sum(map(len, expected.values()))
    for q in expected:
        exact = dict(expected[q])
        assert all(s == pytest.approx(exact[i], rel=1e-12) for i, s in got[q] if i in exact)
