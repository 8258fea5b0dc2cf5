import random
import re
import time

import pytest

from strandlake.operators import align as al
from strandlake.operators.align import align, best_alignment
from strandlake.sources.config import Penalties


def naive(q, r, p):
    far = -(10**9)
    h = [[0] * (len(r) + 1) for _ in range(len(q) + 1)]
    e = [[far] * (len(r) + 1) for _ in range(len(q) + 1)]
    f = [[far] * (len(r) + 1) for _ in range(len(q) + 1)]
    for i in range(1, len(q) + 1):
        for j in range(1, len(r) + 1):
            e[i][j] = max(h[i - 1][j] - p.gap_open, e[i - 1][j] - p.gap_extend)
            f[i][j] = max(h[i][j - 1] - p.gap_open, f[i][j - 1] - p.gap_extend)
            s = 0 if "N" in (q[i - 1], r[j - 1]) else p.match if q[i - 1] == r[j - 1] else -p.mismatch
            h[i][j] = max(0, h[i - 1][j - 1] + s, e[i][j], f[i][j])
    return max(map(max, h))


def score(a, q, r, p):
    i, j, total = a.q_start, a.r_start, 0
    for n, op in re.findall(r"(\d+)([MID])", a.cigar):
        n = int(n)
        if op == "M":
            total += sum(0 if "N" in (x, y) else p.match if x == y else -p.mismatch for x, y in zip(q[i : i + n], r[j : j + n], strict=True))
            i, j = i + n, j + n
        else:
            total -= p.gap_open + (n - 1) * p.gap_extend
            i, j = (i + n, j) if op == "I" else (i, j + n)
    assert (i, j) == (a.q_end, a.r_end)
    return total


@pytest.mark.parametrize("seed", range(60))
def test_score_and_path(seed):
    rng = random.Random(seed)
    p = rng.choice([Penalties(5, 4, 10, 1), Penalties(14, 1, 40, 1), Penalties(1, 1, 2, 1), Penalties(2, 3, 3, 3)])
    r = "".join(rng.choice("ACGTN" if seed % 3 else "ACG") for _ in range(rng.randint(1, 60)))
    q = "".join(rng.choice([c, c, c, c + "A", "", "T"]) for c in r) + "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 9)))
    best = naive(q, r, p)
    for one_pass in (True, False):
        a = align(q, r, p, one_pass)
        if best == 0:
            assert a is None
        else:
            assert a.score == best == score(a, q, r, p)
    assert align(q, r, p, True) == align(q, r, p, False) == align(q, r, p, False, most_cells=64, few_cells=0) == align(q, r, p, few_cells=0)


def test_first_reference_wins_ties():
    assert best_alignment("ACGT", ["ACGT", "ACGT"], Penalties(5, 4, 10, 1), True)[0] == 0
    assert best_alignment("NNN", ["ACGT"], Penalties(5, 4, 10, 1), True) is None


@pytest.mark.parametrize("seed", range(12))
def test_several_references_and_the_band(seed):
    """Long enough that a band is swept; U counts as T and other codes score 0."""
    rng = random.Random(seed)
    p = rng.choice([Penalties(5, 4, 10, 1), Penalties(14, 1, 40, 1), Penalties(1, 1, 2, 1)])
    base = [rng.choice("ACGT") for _ in range(420)]
    refs = ["".join(rng.choice("ACGT") if rng.random() < 0.05 else c for c in base) for _ in range(4)]
    share = rng.choice([0.01, 0.1, 0.6])
    q = [rng.choice(["", "N", "ACG", "T"]) if rng.random() < share else c for c in refs[seed % 4]]
    cut = rng.choice([0, 0, 150])
    q = q[cut : len(q) - cut // 2]
    if seed % 3 == 0:
        q = q[: len(q) // 2] + q[len(q) // 2 + 90 :]  # beyond the first band
    q = "".join(q).replace("T", "U") if seed % 2 else "".join(q)
    plain = q.replace("U", "T")
    scores = [naive(plain, r, p) for r in refs]
    for one_pass, most_cells in ((True, 1 << 26), (False, 1 << 26), (False, 3000)):
        which, a = best_alignment(q, refs, p, one_pass, most_cells)
        assert (which, a.score) == (scores.index(max(scores)), max(scores)) and a.score == score(a, plain, refs[which], p)


def test_long_genomes_are_quick():
    rng = random.Random(9)
    ref = "".join(rng.choice("ACGT") for _ in range(29_903))
    q = "".join(rng.choice("ACGT") if rng.random() < 0.003 else c for c in ref[:21_000] + ref[21_009:])
    start = time.perf_counter()
    a = align(q, ref, Penalties(5, 4, 10, 1), False)
    assert a.score == score(a, q, ref, Penalties(5, 4, 10, 1)) and "9D" in a.cigar
    assert time.perf_counter() - start < 60


@pytest.mark.parametrize("seed", range(60))
def test_seeds_leave_nothing_out(seed, monkeypatch):
    """Runs of N, large insertions and deletions and moved parts: as the whole matrix."""
    monkeypatch.setattr(al, "SEED", 4)
    monkeypatch.setattr(al, "BIN", 4)
    rng = random.Random(seed)
    p = rng.choice([Penalties(5, 4, 10, 1), Penalties(14, 1, 40, 1), Penalties(1, 1, 8, 1), Penalties(2, 3, 3, 3), Penalties(1, 1, 2, 4)])
    some = lambda k: "".join(rng.choice("ACGT") for _ in range(k))
    r = some(rng.randint(40, 220))
    a, b = sorted(rng.sample(range(len(r)), 2))
    q = ["N" * rng.randint(0, 60) + r[:a] + some(rng.randint(0, 40)) + r[b:], r[:a] + "N" * (b - a) + r[b:], r[a:] + r[:a], r[:a] + some(50) + r[a:]][seed % 4]
    refs = [r, "".join(rng.choice("ACGTN") if rng.random() < 0.05 else c for c in r)][: 1 + seed % 3 // 2]
    whole = best_alignment(q, refs, p, True)
    for one_pass in (True, False):
        assert best_alignment(q, refs, p, one_pass, few_cells=0) == whole
    assert best_alignment(q, refs, p, False, most_cells=500, few_cells=0) == whole


def test_runs_of_n_and_large_indels_are_quick():
    rng = random.Random(10)
    some = lambda k: "".join(rng.choice("ACGT") for _ in range(k))
    ref, p = some(29_903), Penalties(1, 1, 8, 1)
    q = "".join(rng.choice("ACGT") if rng.random() < 0.005 else c for c in ref)
    plain = al.Alignment(*(getattr(align(q, ref, p, False), f) for f in ("score", "q_start", "q_end", "r_start", "r_end", "cigar")))
    start = time.perf_counter()
    front = align("N" * 8000 + q, ref, p, False)
    assert (front.score, front.q_start, front.q_end, front.cigar) == (plain.score, 8000, 37_903, plain.cigar)
    long = align(q[:9000] + some(900) + q[9000:20_000] + q[20_600:], ref, p, False)
    assert sorted(int(n) for n in re.findall(r"(\d+)[ID]", long.cigar))[-2:] == [600, 900]
    assert time.perf_counter() - start < 60


@pytest.mark.parametrize("seed", range(20))
def test_many_at_a_time_as_one_by_one(seed):
    rng = random.Random(seed)
    p = rng.choice([Penalties(5, 4, 10, 1), Penalties(14, 1, 40, 1), Penalties(1, 1, 2, 1), Penalties(2, 3, 3, 3), Penalties(1, 1, 2, 4)])
    size = rng.choice([1, 2, 3, 50, 90])
    refs = ["".join(rng.choice("ACGTN") for _ in range(size))] * 2
    refs[1] = "".join(rng.choice("ACGT") if rng.random() < 0.1 else c for c in refs[0])
    queries = ["".join(rng.choice([c, c, c, c + "AG", "", "", "T"]) for c in rng.choice(refs)) + "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 9))) for _ in range(40)] + ["", "N", "NNNN"]
    one_by_one = [best_alignment(q, refs, p, True) for q in queries]
    assert al.best_alignments(queries, refs, p, True) == one_by_one
    assert al.best_alignments(queries, refs, p, True, few_cells=0) == [best_alignment(q, refs, p, True, few_cells=0) for q in queries]
    assert one_by_one == [best_alignment(q, refs, p, True, few_cells=0) for q in queries]


def test_small_alignments_are_quick():
    """2000 different queries of some 120 bases with two references; one by one they took some 4 ms each."""
    rng = random.Random(3)
    ref = "".join(rng.choice("ACGT") for _ in range(120))
    queries = ["".join(rng.choice("ACGT") if rng.random() < 0.05 else c for c in ref) for _ in range(2000)]
    p, refs = Penalties(14, 1, 40, 1), [ref, ref[:60] + "A" + ref[61:]]
    best_alignment(queries[0], refs, p, True)
    start = time.perf_counter()
    one_by_one = [best_alignment(q, refs, p, True) for q in queries[:100]]
    single = (time.perf_counter() - start) * 20
    start = time.perf_counter()
    assert al.best_alignments(queries, refs, p, True)[:100] == one_by_one
    took = time.perf_counter() - start
    print(single, took)
    assert took < single / 2
