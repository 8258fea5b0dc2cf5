import numpy as np
from pyspark.sql import functions as F

from strandlake.llm.neighbours import fit_index, nearest, probes_for, scan

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k, is_query):
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids = np.array([i for i, _ in good])
    x = np.stack([v for _, v in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in np.flatnonzero([is_query(i) for i in ids]):
        s = x @ x[q]
        s[q] = -9
        order = np.lexsort((ids, -np.round(s, 12)))[: min(k, len(ids) - 1)]
        out[int(ids[q])] = [int(i) for i in ids[order]]
    return out


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA).repartition(4)
    got = {}
    for r in sorted(nearest(df, F.col("vec_id") % 10 == 0, **more).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r)
    return got


def test_recall_and_scores(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=32).astype(np.float32)]) for i in range(800)]
    want, got = brute(rows, 5, lambda i: i % 10 == 0), run(spark, rows)
    assert set(got) == set(want)
    hits = sum(len({r.vec_id for r in got[q]} & set(want[q])) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    vec = {i: np.array(v) for i, v in rows}
    for q, found in got.items():
        assert [r["rank"] for r in found] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        for r in found:
            assert np.isclose(r.score, vec[q] @ vec[r.vec_id] / np.linalg.norm(vec[q]) / np.linalg.norm(vec[r.vec_id]), rtol=1e-12)


def test_copies_ties_and_odd_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(60)] + [(100, [1.0, 0.0, 0.0]), (101, [0.0, 1.0, 0.0]), (110, None), (111, [0.0, 0.0, 0.0]), (112, [1.0, float("nan"), 0.0]), (113, [1.0, None, 0.0]), (114, [float("inf"), 1.0, 1.0]), (115, []), (116, [1.0, 2.0])]
    got = run(spark, rows, probe_share=1.0)
    assert set(got) == {0, 10, 20, 30, 40, 50, 100}
    assert [r.vec_id for r in got[0]] == [1, 2, 3, 4, 5] and [r.vec_id for r in got[30]] == [0, 1, 2, 3, 4]
    assert {r.vec_id for x in got.values() for r in x}.isdisjoint({110, 111, 112, 113, 114, 115, 116})


def test_few_and_none(spark):
    assert [r.vec_id for r in run(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])])[0]] == [2, 1]
    assert run(spark, [(0, [1.0, 0.0])]) == {}
    assert run(spark, [(0, None)]) == {}
    assert nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0).count() == 0
    assert [r.vec_id for r in run(spark, [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (5, [1.0, 0.1])])[0]] == [5]


def test_many_groups_equal_one(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=16).astype(np.float32)]) for i in range(400)]
    want = brute(rows, 5, lambda i: i % 10 == 0)
    got = run(spark, rows, probe_share=1.0, epsilon=50.0, lists=3, group=8)
    assert {q: [r.vec_id for r in found] for q, found in got.items()} == want


def test_one_vector_in_a_third_of_all_rows(spark):
    rng = np.random.default_rng(10)
    same = [float(x) for x in rng.normal(size=8)]
    rows = [(i, same if i % 3 == 0 else [float(x) for x in rng.normal(size=8)]) for i in range(600)]
    got = run(spark, rows, probe_share=1.0, epsilon=50.0)
    for q in range(0, 600, 30):
        assert [r.vec_id for r in got[q]] == [i for i in range(0, 21, 3) if i != q][:5]


def test_scan_over_several_parts():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(500, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = set(np.argsort(-(x @ x[7]), kind="stable")[:6])
    assert want <= set(scan(x, x[7], 6, 8, 50.0, rows_at_once=64))


def test_fewer_lists_are_probed_where_vectors_lie_in_clusters():
    rng = np.random.default_rng(12)
    spread = rng.normal(size=(1000, 32))
    dense = np.repeat(rng.normal(size=(20, 32)), 50, axis=0) + rng.normal(size=(1000, 32)) * 0.05
    rng.shuffle(dense)
    few, many = (probes_for(x[:200], x, fit_index(x[200:], 20), 5, 0.97) for x in (dense, spread))
    assert few <= 3 and many >= 12
    assert probes_for(spread[:0], spread, fit_index(spread, 4), 5, 0.97) == 4
