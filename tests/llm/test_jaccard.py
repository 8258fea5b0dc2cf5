import random
import re

import numpy as np
import pytest

from strandlake.llm import jaccard
from strandlake.llm.jaccard import coarse_counts, coarse_table, join, keep_first, prefix_length, shared_rows, star_cover

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows))


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    common = [f"c{i}" for i in range(60)]
    rows = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([3, 5, 8, 30, 120, 300]))]
        if rng.random() < 0.4:
            base = base[: len(base) // 2] + common + base[len(base) // 2 :]
        for _ in range(rng.choice([1, 1, 2, 6, 25])):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((rng.randrange(1 << 40), rng.choice([" ", "  ", "\n"]).join(copy).upper() if rng.random() < 0.3 else " ".join(copy)))
    return rows + [(1, None), (2, ""), (3, " \t\n"), (4, "Éa éa"), (5, "éa éa"), (6, "one"), (7, "ONE")]


def crowded(seed):
    """Near copies of one text, many more than fit a block, most of them below the threshold; groups of several sets."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(70)]
    rows = []
    for k in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(70)] = f"x{rng.randrange(10_000)}"
        rows.append((k, " ".join(copy)))
    common = [f"c{i}" for i in range(400)]
    for k in range(100, 140):
        rows.append((k, " ".join(common[rng.randrange(40) :][:200] + base[:6])))
    return rows + [(1007, "b1 b2 b3 b4 b5 b6"), (1008, None)]


OPEN = {"block": 8, "pairs_each": 0}


@pytest.mark.parametrize("make, seed, options", [(corpus, 1, {}), (crowded, 1, {"least": 2, **OPEN}), (crowded, 2, {"least": 1 << 40, "most_bits": 1 << 6, **OPEN})])
def test_against_brute_force(spark, make, seed, options):
    rows = make(seed)
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n int, sid string").repartition(5)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in join(df, **options).collect())
    assert got == brute(rows)


def test_repeated_rows_missing_ids_and_empty_tables(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (None, "g h i j k l m"), (9, None), (9, None)]
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in join(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == [(0, 2, 5), (0, 3, 0), (5, 2, 5), (5, 2, 5), (9, 0, 9), (9, 0, 9)]
    assert join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_row_of_each_component_stays(spark):
    a, near, other = "a b c d e f g h i j k l m n o p", "a b c d e f g h i j k l m n o q", "r s t u v w"
    rows = [(5, a, 1), (5, a, 2), (None, near, 3), (None, a, 4), (7, other, 5), (5, other, 6), (9, None, 7), (9, None, 8), (8, " ", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, own_id int")
    got = keep_first(df)
    assert got.columns == df.columns
    found = sorted((r.doc_id, r.text or "") for r in got.collect())
    assert found == [(5, a), (5, other), (8, " "), (9, ""), (9, "")]
    assert keep_first(df.filter("false")).count() == 0


def test_a_very_long_text(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400_000)]
    near = list(words)
    near[1000:1200] = ["changed"] * 200
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, "short one")], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in join(df).collect()) == [(1, 1), (2, 1), (3, 3)]


def test_bounds():
    rng = np.random.default_rng(3)
    for n, m in ((5, 7), (100, 90), (5000, 6000), (30_000, 20_000), (90_000, 100_000)):
        pool = rng.integers(0, 1 << 63, 150_000, dtype=np.uint64) << np.uint64(1)
        a, b = np.unique(pool[:n]), np.unique(pool[n // 2 : n // 2 + m])
        counts = coarse_table([coarse_counts(a), coarse_counts(b), None])
        assert counts[0].sum() == len(a)
        assert np.minimum(counts[0], counts[1]).sum() >= len(np.intersect1d(a, b))
        assert (counts[2] == 65535).all()
    assert [prefix_length(n, 80) for n in (1, 4, 5, 10, 11)] == [1, 1, 2, 3, 3]


@pytest.mark.parametrize("most_held", [1 << 20, 3])
def test_shared_tokens(spark, most_held):
    rng = random.Random(1)
    rows = [(bytes([g]) * 16, 3, sorted(rng.sample(range(40), 5))) for g in range(30)] + [(bytes([99]) * 16, 3, [1000, 1001, 1002, 5, 6])] * 3
    signed = spark.createDataFrame(rows, "gid binary, rare int, prefix array<long>")
    groups = {}
    for g, rare, prefix in rows:
        for t in prefix[:rare]:
            groups.setdefault(t, set()).add(g)
    got = shared_rows(signed, most_held).filter("pos < 3").collect()
    assert {r.token for r in got} >= {t for t, g in groups.items() if len(g) > 1}
    if most_held > 3:
        assert sorted((r.token, r.same) for r in got) == sorted((t, s) for t, s in {(r.token, r.same) for r in got} for _ in groups[t]) and all(len(groups[r.token]) > 1 for r in got)
    for t, g in groups.items():
        if len(g) > 1:
            assert len({r.g for r in got if r.token == t}) == len(g)


@pytest.mark.parametrize("seed", range(5))
def test_star_cover(seed):
    rng = np.random.default_rng(seed)
    a, b = np.triu_indices(30, 1)
    some = rng.random(len(a)) < 0.1
    a, b = a[some], b[some]
    taken = star_cover(a, b, 30)
    assert taken.sum() <= 30 and set(np.concatenate((a[taken], b[taken]))) == set(np.concatenate((a, b)))


def test_a_star_of_many_shares(spark, monkeypatch):
    """One set links with very many others, which are dealt to shares of two; some are copies, some have no id."""
    monkeypatch.setattr(jaccard, "OTHERS", 2)
    base = [f"w{i}" for i in range(70)]
    rows = [(i, " ".join([*base[:20], f"x{i}", *base[20:]] if i else base)) for i in range(40)]
    rows += [(100 + i, " ".join(base)) for i in range(5)] + [(None, " ".join(base))] * 3 + [(200, "quite another text of seven words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for block in (4, 512):
        got = {r.doc_id: r.component_id for r in join(df, block=block).collect() if r.doc_id is not None}
        assert got == {i: 0 if i < 200 else 200 for i, _ in rows if i is not None}
