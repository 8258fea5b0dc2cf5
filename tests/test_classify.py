import random
from collections import Counter

import numpy as np
import pytest

from strandlake.operators.classify import KmerIndex, Thresholds, classifier, kmers
from strandlake.plans.annotate import prepare, unclassified
from strandlake.sources.config import Reference

FLIP = str.maketrans("ACGT", "TGCA")


def some(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def turned(s):
    return s.translate(FLIP)[::-1]


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    refs = {t: some(rng, 900) for t in "ABC"} | {"D": None}
    refs["D"] = refs["C"][:450] + some(rng, 450)  # half of it is C's
    listed = [Reference("r" + t, t, i, s) for i, (t, s) in enumerate(refs.items())] + [Reference("rA", "A", 9, refs["A"][:400] + some(rng, 500))]
    return refs, KmerIndex.of(listed), rng


def changed(rng, s, share):
    return "".join(rng.choice("ACGT") if rng.random() < share else c for c in s)


def ask(spark, index, seqs, **more):
    df = spark.createDataFrame([(str(i), None, s, i) for i, s in enumerate(seqs)], "id string, ctype string, seq string, status_of int").repartition(3)
    rows = classifier(index, Thresholds(), **more)(df).collect()
    return [r for _, r in sorted((r.status_of, r) for r in rows)]


def cases(refs, rng):
    a, b, c, d = (refs[t] for t in "ABCD")
    return [a, turned(changed(rng, b, 0.05)), b.lower().replace("t", "u"), a[:450] + b[450:], a[:450] + turned(a[450:]), some(rng, 800), c + c, c[:440], d[460:], "N" * 500, "ACGT", "", None, "N" * 300 + a[300:600] + "N" * 300, a[100:300]]


WANT = ["classified", "classified", "classified", "chimeric", "chimeric", "unrecognizable", "unusually long", "unresolvable", "classified", "unrecognizable", "unrecognizable", "unrecognizable", "unrecognizable", "classified", "classified"]


@pytest.mark.parametrize("most_bytes", [1 << 28, 0])
def test_each_status(spark, case, most_bytes):
    refs, index, rng = case
    got = ask(spark, index, cases(refs, random.Random(4)), most_bytes=most_bytes)
    assert [r.status for r in got] == WANT
    assert [(r.classified, r.strand) for r in got[:3]] == [("A", "+"), ("B", "-"), ("B", "+")]
    assert got[3].taxa == ["A", "B"] and got[4].taxa == ["A"] and got[7].taxa == ["C", "D"] and got[6].classified == "C"
    assert got[13].kmers == 300 - index.k + 1 == got[13].hits


def test_search_and_join_agree(spark, case):
    refs, index, _ = case
    rng = random.Random(5)
    seqs = [changed(rng, rng.choice(list(refs.values()))[rng.randint(0, 400) :], rng.random() * 0.3) for _ in range(60)] * 2
    seqs = [turned(s) if i % 2 else s for i, s in enumerate(seqs)]
    a, b = (ask(spark, index, seqs, most_bytes=m) for m in (1 << 28, 0))
    assert a == b and len(Counter(r.status for r in a)) > 1


def test_kmers_by_brute_force():
    rng = random.Random(6)
    seq = "".join(rng.choice("ACGTN-U") if rng.random() < 0.1 else rng.choice("ACGT") for _ in range(300))
    code = {"A": 0, "C": 1, "G": 2, "T": 3, "U": 3}
    number = lambda w: sum(code[c] * 4 ** (len(w) - 1 - i) for i, c in enumerate(w))
    for k in (1, 5, 13, 31):
        plus, minus, good = kmers(seq, k)
        for i in range(len(seq) - k + 1):
            w = seq[i : i + k]
            assert good[i] == (set(w) <= set(code))
            if good[i]:
                assert plus[i] == number(w) and minus[i] == number(turned(w.replace("U", "T")))
    assert len(kmers("ACG", 4)[0]) == 0


def test_index_holds_each_pair_once():
    index = KmerIndex.of([Reference("x", "A", 0, "ACGTACGTNACG"), Reference("y", "B", 1, "CGTA")], 4)
    pairs = {(int(n), index.ctypes[m]) for n, lo, hi in zip(index.numbers, index.first[:-1], index.first[1:], strict=True) for m in index.members[lo:hi]}
    assert len(pairs) == len(index.members) == 5 and np.all(np.diff(index.numbers.astype(np.int64)) > 0)
    assert index.longest == (12, 4)
    assert KmerIndex.of([], 4).nbytes() >= 0


def test_no_references_tell_nothing(spark):
    assert [r.status for r in ask(spark, KmerIndex.of([]), ["ACGT" * 30])] == ["unrecognizable"]


def test_prepare_turns_and_drops(spark, case):
    refs, index, _ = case
    raw = spark.createDataFrame([("p", None, turned(refs["A"])), ("q", "given", refs["B"]), ("r", None, "ACGT" * 100), ("s", None, refs["A"][:450] + refs["B"][450:])], "id string, ctype string, seq string")
    tell = classifier(index)
    got = {r.query_id: (r.ctype, r.nt) for r in prepare(raw, classifier=tell).collect()}
    assert got == {"p": ("A", refs["A"]), "q": ("given", refs["B"])}
    assert {r.id: r.status for r in unclassified(raw, tell).collect()} == {"r": "unrecognizable", "s": "chimeric"}


@pytest.mark.parametrize("seed", range(10))
def test_hits_of_many_sequences_as_of_each(seed):
    """By looking up each k-mer of each sequence; none spans two sequences."""
    rng = random.Random(seed)
    letters = "ACGT"
    k, segments = rng.choice([3, 5]), 4
    index = KmerIndex.of([Reference(f"r{i}", "ABC"[i % 3], 0, "".join(rng.choice(letters) for _ in range(40))) for i in range(5)], k)
    seqs = ["".join(rng.choice("ACGTNU") for _ in range(rng.choice([0, 1, k - 1, k, k + 1, 30, 77]))) for _ in range(25)]
    got, valid = index.hits(seqs, segments)
    for s, hits, own in zip(seqs, got, valid, strict=True):
        plus, minus, good = kmers(s, k)
        want, want_valid = np.zeros_like(hits), np.zeros_like(own)
        for at in np.flatnonzero(good).tolist():
            segment = at * segments // len(plus)
            want_valid[segment] += 1
            for strand, numbers in enumerate((plus, minus)):
                for i in np.flatnonzero(index.numbers == numbers[at]).tolist():
                    for member in index.members[index.first[i] : index.first[i + 1]].tolist():
                        want[strand, member, segment] += 1
        assert (hits == want).all() and (own == want_valid).all()
