import random

import pytest

from strandlake.operators.intervals import interval_join, nearest_regions


def ranges(rng, n, longest, line, keys="ab"):
    out = []
    for i in range(n):
        s = rng.randint(-line // 10, line)
        out.append((rng.choice(keys), i, s, s + rng.choice([1, 2, rng.randint(1, longest), 8, 64, 65])))
    return out


@pytest.mark.parametrize("seed,longest,line", [(1, 20, 300), (2, 3000, 4000), (3, 9, 20), (4, 10**6, 10**7)])
def test_overlaps_by_brute_force(spark, seed, longest, line):
    rng = random.Random(seed)
    a, b = ranges(rng, 300, longest, line), ranges(rng, 200, longest // 2, line)
    a += [("a", 1000, 0, line * 2), ("b", 1001, 5, 5), ("a", 1002, None, 4), (None, 1003, 0, 9)] + a[:3]
    b += [("a", 2000, -line, line), ("a", 2001, 7, None), (None, 2002, 0, 9), ("b", 2003, 9, 3)]
    left = spark.createDataFrame(a, "k string, i int, s long, e long").repartition(4)
    right = spark.createDataFrame(b, "k string, j int, s2 int, e2 int" if line < 10**6 else "k string, j int, s2 long, e2 long")
    got = sorted((r.i, r.j) for r in interval_join(left, right, ["k"], ("s", "e"), ("s2", "e2")).collect())
    good = lambda x: None not in x and x[2] < x[3]
    want = sorted((x[1], y[1]) for x in filter(good, a) for y in filter(good, b) if x[0] == y[0] and x[2] < y[3] and y[2] < x[3])
    assert got == want and got


def test_a_shared_range_in_a_third_of_all_rows(spark):
    a = [("k", i, 100, 200) for i in range(300)] + [("k", 300 + i, i * 7, i * 7 + 3) for i in range(300)]
    b = [("k", j, j * 50, j * 50 + 60) for j in range(20)]
    left, right = spark.createDataFrame(a, "k string, i int, s long, e long"), spark.createDataFrame(b, "k string, j int, s2 long, e2 long")
    got = interval_join(left, right, ["k"], ("s", "e"), ("s2", "e2"))
    assert got.count() == sum(x[2] < y[3] and y[2] < x[3] for x in a for y in b)
    assert not any("Cartesian" in line or "NestedLoop" in line for line in got._jdf.queryExecution().toString().splitlines())


def test_names_of_both_sides_and_empty_tables(spark):
    left = spark.createDataFrame([("k", 1, 2)], "k string, s long, e long")
    with pytest.raises(ValueError, match="both sides"):
        interval_join(left, left, ["k"], ("s", "e"), ("s", "e"))
    none = spark.createDataFrame([], "k string, c long, d long")
    assert interval_join(left, none, ["k"], ("s", "e"), ("c", "d")).count() == 0
    assert interval_join(none, left, ["k"], ("c", "d"), ("s", "e")).count() == 0
    assert [tuple(r) for r in nearest_regions(left, none, ["k"], ("s", "e"), ("c", "d")).collect()] == [("k", 1, 2, None, None)]


@pytest.mark.parametrize("width", [1, 10, 1 << 16])
def test_nearest_by_brute_force(spark, width):
    rng = random.Random(width)
    rows = ranges(rng, 300, 30, 1000, "abc") + [("a", 900, 50, 55)] * 200 + [("a", 901, None, 55), ("a", 903, 50, None), (None, 902, 1, 2)]
    regions = [(k, s, e) for k, _, s, e in ranges(rng, 60, 40, 1000, "ab")] + [("a", None, 3), (None, 0, 1), ("a", 5, None)]
    df = spark.createDataFrame(rows, "k string, i int, s int, e int").repartition(4)
    reg = spark.createDataFrame(regions, "k string, c long, d long")
    got = sorted((tuple(r) for r in nearest_regions(df, reg, ["k"], ("s", "e"), ("c", "d"), width).collect()), key=repr)
    want = []
    for k, i, s, e in rows:
        own = [r for r in regions if r[0] == k and k is not None]
        left = max((d for _, _, d in own if d is not None and None not in (s, e) and d <= s), default=None)
        right = min((c for _, c, _ in own if c is not None and None not in (s, e) and c >= e), default=None)
        want.append((k, i, s, e, left, right))
    assert got == sorted(want, key=repr)
