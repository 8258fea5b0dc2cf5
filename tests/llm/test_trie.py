import hashlib
import random
import zlib

import pytest

from strandlake.llm.trie import Trie, rebuilt, trie, turns

SCHEMA = "conv_id long, turn long, role string, text string, turns string, d int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(convs):
    """Nodes over {conv_id: [(role, text), ..]} as rows."""
    members = {}
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    kids, leaves, saved = ({} for _ in range(3))
    for s in sorted(members, key=len, reverse=True):
        kids.setdefault(s, 0)
        leaves[s] = leaves.get(s, 0) or 1
        saved[s] = saved.get(s, 0) + ((len(members[s]) - 1) * len(s[-1][1]) if s else 0)
        if s:
            up = s[:-1]
            kids[up], leaves[up], saved[up] = kids.get(up, 0) + 1, leaves.get(up, 0) + leaves[s], saved.get(up, 0) + saved[s]
    out = []
    for s, own in members.items():
        ends = sorted(c for c in own if len(convs[c]) == len(s))
        out.append((min(own), len(s), min(members[s[:-1]]) if s else None, len(own), kids[s], leaves[s], saved[s], sha(",".join(map(str, ends)))))
    return sorted(out, key=repr)


def original(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(t, key=lambda x: x[:2])] for c, t in convs.items()}


def collect(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, convs):
    rows = [(c, k, r, t, "x", 1) for c, own in convs.items() for k, (r, t) in enumerate(own)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def some(n, seed=3, letters="ab", longest=6):
    r = random.Random(seed)
    return {i: [("user" if k % 2 else "bot", r.choice(letters) * r.choice((1, 1, 3))) for k in range(r.randint(1, longest))] for i in range(n)}


@pytest.mark.parametrize("most", [1, 5, 40, 1 << 16])
def test_tries_of_all_sizes(spark, most):
    convs = some(300)
    assert collect(trie(turns(frame(spark, convs)), most)) == brute(convs)


def test_trunks_that_are_dealt_anew(spark):
    """All start with 30 equal turns, some end there; further trunks follow below."""
    stem = [("u", f"stem {i}") for i in range(30)]
    convs = {i: stem + ([("u", "more")] * (i % 9) + [("b", f"{i % 40}")] if i % 5 else []) for i in range(200)}
    convs |= {1000 + i: [("x", "y")] * 12 for i in range(50)} | {2000: [("x", "y")] * 400}
    for most in (3, 60):
        assert collect(trie(turns(frame(spark, convs)), most)) == brute(convs)


def test_rebuilt(spark):
    convs = some(330, seed=5, letters="abc")
    del convs[200]
    bases = {c: convs.get(c - c % 100, []) for c in convs}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in convs}
    want = {c: bases[c][: h[c]] + t[h[c] :] for c, t in convs.items()}
    assert any(not t for t in want.values())  # members of the root only
    got = trie(rebuilt(turns(frame(spark, convs))))
    assert collect(got) == brute(want)
    assert collect(trie(rebuilt(turns(frame(spark, convs))), 4)) == brute(want)


def test_nulls_repeats_and_odd_texts(spark):
    rows = [(1, None, "u", "first"), (1, 0, None, None), (1, 1, "", ""), (2, 0, "u", "first"), (2, 1, None, ""), (3, 5, "u", "ü😀" * 50_000), (4, 5, "u", "ü😀" * 50_000), (None, 0, "u", "lost"), (5, 0, "a", "b:c"), (6, 0, "a:b", "c"), (7, -1, "u", "first"), (7, -1, "u", "first"), (-8, 0, "u", "x")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = collect(trie(turns(df)))
    assert got == brute(original(rows))
    assert next(r for r in got if r[1] == 0)[0] == -8


def test_turns_of_one_number_have_one_order(spark):
    rows = [(c, 0, "u", t, "x", 1) for c in (1, 2) for t in ("pqr" if c == 1 else "rqp")]
    got = collect(trie(turns(spark.createDataFrame(rows, SCHEMA).repartition(3))))
    assert len(got) == 4 and all(r[3] == 2 for r in got)


def test_nothing(spark):
    assert trie(turns(spark.createDataFrame([], SCHEMA))).collect() == []
    lone = spark.createDataFrame([(3, 0, "u", "t", "x", 1)], SCHEMA)
    assert collect(trie(rebuilt(turns(lone)))) == brute({3: [("u", "t")] if zlib.crc32(b"3") % 6 == 0 else []})


def test_postorder_is_iterative():
    made = Trie()
    top = made.node(-1, 1, 2, 0)
    digests = [bytes([i % 256, i // 256]) for i in range(50_000)]
    made.add(top, digests, [2] * 50_000, 3, 0, "e")
    made.add(top, digests[:10] + [b"x"], [2] * 11, 1, 1, "e")
    leaves, saved = made.sums([top])
    assert leaves[top] == 2 and saved[top] == 2 * (10 * 3 + 49_990 * 2)
    order = list(made.postorder([top]))
    place = {n: i for i, n in enumerate(order)}
    assert all(place[k] < place[n] for n in order for k in made.below[n].values())
