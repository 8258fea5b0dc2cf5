import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.llm.mtree import Search, lifted, make_page, products, spread_out, top_products

SCHEMA = "vec_id long, embedding array<double>, c string, x int"


def brute(rows, k, every):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.setdefault((i, tuple(int(np.floor(256 * float(x))) for x in v)))
    out = []
    for q, x in good:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in good if i != q and len(x) == len(y))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, every=10, **more):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(5)
    return sorted(tuple(r) for r in top_products(df, F.col("vec_id") % every == 0, **more).collect())


def vectors(n, dims, seed, clusters=0, scale=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) * scale
    if clusters:
        x = rng.normal(size=(clusters, dims))[rng.integers(clusters, size=n)] * 3 + x * 0.05
    return [(i, [float(a) for a in v]) for i, v in enumerate(x)]


@pytest.mark.parametrize("more", [{}, {"page": 16, "leaf": 4, "group": 2, "objects": 7}, {"page": 8, "leaf": 3, "group": 1, "sample": 10, "queries_at_once": 7}, {"page": 64, "leaf": 64, "k": 1}])
def test_equals_brute_force(spark, more):
    for rows in (vectors(400, 6, 1), vectors(300, 12, 2, clusters=8)):
        assert run(spark, rows, **more) == brute(rows, more.get("k", 5), 10)


def test_lengths_that_differ_much(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(rng.normal(size=(300, 5)) * rng.lognormal(0, 3, size=(300, 1)))]
    assert run(spark, rows, page=20, leaf=5, group=2) == brute(rows, 5, 10)


def test_ties_and_copies(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(rng.integers(-1, 2, size=(300, 3)) / 4)]
    rows += [(i, [0.5, 0.5, 0.25]) for i in range(300, 450)]  # one vector in a third of all rows
    rows += rows[:20] + [(10, [9.0, 9.0, 9.0])]
    assert run(spark, rows, page=16, leaf=4) == brute(rows, 5, 10)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, nan]), (3, [inf, 1.0]), (4, [None, 1.0]), (10, [0.0, 0.0]), (20, []), (30, []), (40, [1.0]), (None, [1.0, 2.0]), (50, [-0.001, 0.5]), (7, [0.5, 0.5])]
    got = run(spark, rows)
    assert got == brute(rows, 5, 10)
    assert (20, 1, 30, 0) in got and all(r[0] != 40 for r in got)


def test_large_components_are_exact(spark):
    rows = [(i, [float(2**44 + i), float(2**44 - 3 * i), 1.0]) for i in range(30)]
    want = [(q, n, i, min(s, 2**63 - 1)) for q, n, i, s in brute(rows, 5, 10)]
    assert [r[3] for r in run(spark, rows)] == [r[3] for r in want]
    rows = [(i, [float(2**18 + i) / 256 * 2**5, float(2**20 - 3 * i), 1.0]) for i in range(30)]
    assert run(spark, rows) == brute(rows, 5, 10)
    assert products(np.array([[2.0**40, 1.0]]), np.array([2.0**22, 1.0])).tolist() == [2**62 + 1]


def test_few_and_none(spark):
    assert run(spark, [(0, [1.0, 0.0])]) == []
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    assert run(spark, []) == []


def test_bounds_spare_computations():
    """In clusters, stored distances rule out most entries and nodes; the result is that of all of them."""
    rng = np.random.default_rng(5)
    x = np.floor(256 * (np.repeat(rng.normal(size=(40, 16)), 100, axis=0) + rng.normal(size=(4000, 16)) * 0.02))
    radius2 = float((x * x).sum(1).max())
    points = lifted(x, radius2)
    assert np.allclose((points * points).sum(1), radius2)
    root = points[spread_out(points, 1)]
    pages = [make_page(x[i : i + 1000], np.sqrt(((points[i : i + 1000] - root) ** 2).sum(1)), [[j] for j in range(i, i + 1000)], radius2, 50) for i in range(0, 4000, 1000)]
    for q in (x[5], x[3333], -x[100]):
        search = Search(q, 6, -np.inf, radius2)
        away = float(np.sqrt(((np.append(q, 0.0) - root) ** 2).sum()))
        got = sorted((-s, -i) for s, i in search.run(pages, away))
        assert got == sorted((-int(s), i) for i, s in enumerate(x @ q))[:6]
        assert search.computed < 2000
