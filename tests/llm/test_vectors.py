from __future__ import annotations

import numpy as np
import pytest

from parcella.llm import vectors


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, v array<float>, label int")


def nearest(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([np.array(v, np.float32) for _, v in rows], float)
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        s = (x * x[q]).sum(axis=1)
        order = [o for o in np.lexsort((ids, -s)) if ids[o] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[o]), s[o]) for o in order]
    return out


def search(spark, rows, k, **options):
    data = frame(spark, [(i, [float(a) for a in v], 0) for i, v in rows])
    queries = data.where("vec_id % 20 = 0").selectExpr("vec_id as query_id", "v as q")
    out = {}
    for r in vectors.search(vectors.Index(data, **options), queries, k).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_exact_on_clustered_and_shapeless_data(spark, spread):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 16))
    x = centres[rng.integers(0, 6, 900)] + spread * rng.normal(size=(900, 16))
    x[100:400] = x[100]  # a third of all vectors are equal
    rows = list(enumerate(x))
    got, want = search(spark, rows, 20, centroids=8), nearest(rows, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(0, None), (20, [0.0, 0.0]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, [None, 1.0]), (4, [1.0]), (None, [1.0, 1.0])]
    good = [(40, [1.0, 0.0]), (5, [2.0, 0.0]), (6, [2.0, 0.0]), (7, [-1.0, 0.5])]
    data = frame(spark, [(i, v, 0) for i, v in bad + good])
    queries = data.where("vec_id % 20 = 0").selectExpr("vec_id as query_id", "v as q")
    got = vectors.search(vectors.Index(data), queries, 20).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [
        (40, 1, 5, 2.0), (40, 2, 6, 2.0), (40, 3, 7, -1.0),
    ]
    assert vectors.search(vectors.Index(data.limit(0)), queries, 20).count() == 0
    assert vectors.search(vectors.Index(data), queries.limit(0), 20).count() == 0


def test_cells_come_in_falling_order_and_all():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=7), rng.normal(size=5)
    seen = list(vectors.cells_in_order(a, b))
    assert len({(i, j) for _, i, j in seen}) == 35
    assert [s for s, _, _ in seen] == sorted((x + y for x in a for y in b), reverse=True)
