import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from strandlake.llm import fingerprints as fp


def test_entropy_of_every_window():
    rng = random.Random(1)
    raw = np.frombuffer(("".join(rng.choice("abcde  xyz") for _ in range(300)) + "a" * 80 + "".join(map(chr, range(33, 120)))).encode(), np.uint8)
    got = fp.entropy_classes(raw)
    assert len(got) == len(raw) - fp.WINDOW + 1
    for i, c in enumerate(got):
        counts = Counter(raw[i : i + fp.WINDOW].tolist())
        total = sum(round(1024 * n * math.log2(n)) for n in counts.values())
        assert c == (fp._TOP - total) * (fp.CLASSES - 1) // fp._TOP


def texts(seed=2, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    return [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 8, 60, 400]))) for _ in range(n)]


def brute_selection(text: bytes, ranks) -> list[int]:
    """Ends of the selected windows, counted from the definition."""
    n = len(text)
    padded = bytes(fp.WINDOW - 1) + text
    rank = []
    for i in range(n):
        total = sum(round(1024 * c * math.log2(c)) for c in Counter(padded[i : i + fp.WINDOW]).values())
        rank.append(int(ranks[(fp._TOP - total) * (fp.CLASSES - 1) // fp._TOP]))
    points = Counter()
    for lo in range(1 - fp.STRETCH, n) if n else ():
        stretch = range(max(0, lo), min(n, lo + fp.STRETCH))
        points[min(stretch, key=lambda i: (rank[i], i))] += 1
    return [i for i in range(n) if points[i] >= fp.POINTS]


def test_selection_from_its_definition():
    rng = random.Random(8)
    some = [*texts(9, 20), "", "a", "ab", "é", "aaaa" * 30, "x" * 15 + "y", "x" * 16, "\0\0a", *["".join(rng.choice("abc d") for _ in range(n)) for n in range(1, 70, 3)]]
    ranks = fp.ranks_of(fp.histogram(pa.array(some)))
    raw, offsets = fp.utf8(pa.array(some, pa.large_string()))
    want = [brute_selection(t.encode(), ranks) for t in some]
    got = []
    for part, at in fp.blocks(raw, offsets):
        places = fp.selected(part, at, ranks)
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            got.append([int(p - lo - fp.PAD + fp.WINDOW - 1) for p in places if lo <= p < hi])
    assert got == want
    assert all(bool(t) == bool(w) for t, w in zip(some, want, strict=True))
    assert [d.features for d in fp.digests(some, ranks)] == [len(w) for w in want]


def brute_likeness(a, b) -> float:
    def bits(hashes):
        starts = list(range(0, len(hashes), fp.FILTER_FEATURES))
        if len(starts) > 1 and len(hashes) - starts[-1] < fp.FILTER_FEATURES // 2:
            del starts[-1]
        return [{int(h) >> 11 * k & 2047 for h in hashes[lo:hi] for k in range(fp.HASHES)} for lo, hi in zip(starts, [*starts[1:], len(hashes)], strict=False)]

    x, y = sorted((bits(a), bits(b)), key=len)
    if not x or not y:
        return float(len(x) == len(y))
    total = 0.0
    for f in x:
        best = 0.0
        for g in y:
            mean = len(f) * len(g) / 2048
            sd = math.sqrt(mean * (1 - len(g) / 2048) * (1 - len(f) / 2048))
            chance = mean + sd * math.sqrt(2 * math.log(len(y)))
            room = min(len(f), len(g)) - chance
            if room >= fp.ROOM * sd:
                best = max(best, min(1.0, max(0.0, (len(f & g) - chance) / room)))
        total += best
    return total / len(x)


def test_likeness_from_its_definition():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    sets = [pool[:n] for n in (0, 1, 3, 79, 80, 160, 239, 240, 900)] + [pool[k : k + n] for k in (2, 100, 300) for n in (1, 40, 200, 500)]
    for a in sets:
        for b in sets:
            assert math.isclose(fp.Digest(a).likeness(fp.Digest(b)), brute_likeness(a, b), abs_tol=1e-9)


def test_digest_depends_on_the_text_only():
    all_texts = texts()
    ranks = fp.ranks_of(fp.histogram(pa.array(all_texts)))
    together = [d.text() for d in fp.digests(all_texts, ranks)]
    assert together == [fp.digests([t], ranks)[0].text() for t in all_texts]
    assert all((t == "") == (d == "") for t, d in zip(all_texts, together, strict=True))
    long = [t for t in all_texts if len(t) > 1500]
    a, b = fp.digests(long[:2], ranks)
    half = fp.digests([long[0][: len(long[0]) // 2] + long[1][: len(long[0]) // 2]], ranks)[0]
    assert a.likeness(a) == 1 and 0.25 < a.likeness(half) < 0.9 and a.likeness(b) < 0.2


def test_short_texts():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    sizes = [20, 40, 63, 64, 90, 127, 141, 142, 200, 300, 511, 512, 600]
    short = [prose(120)[:n] for n in sizes for _ in range(6)]
    long = [prose(n) for n in (1000, 5000, 12000)]
    ranks = fp.ranks_of(fp.histogram(pa.array(short + long)))
    # a text's features don't depend on the texts beside it
    made = fp.digests(short + long, ranks)
    assert [d.text() for d in made] == [fp.digests([t], ranks)[0].text() for t in short + long]
    near = fp.digests([fp.edited(t, prose(120)) for t in short], ranks)
    for k, n in enumerate(sizes):
        six = slice(6 * k, 6 * k + 6)
        assert all(d.likeness(d) == 1 for d in made[six])
        assert 0.2 < np.mean([d.likeness(e) for d, e in zip(made[six], near[six], strict=True)]) < 0.75, n
        assert np.mean([a.likeness(b) for a in made[six] for b in made[:78] if a is not b]) < 0.1, n
        against = [d.likeness(x) for d in made[six] for x in made[78:]]
        assert np.mean(against) < 0.1 and max(against) < 0.35, n
    # the last, partly filled filter isn't like everything
    cut = fp.digests([long[1][: 3000 + 100 * k] for k in range(20)], ranks)
    assert max(d.likeness(made[-1]) for d in cut) < 0.2


def test_next_document_and_edits(spark):
    all_texts = texts(3, 80)
    ids = random.Random(5).sample(range(10**6), 80)
    rows = [*zip(ids, all_texts, strict=True), (10**7, None), (5 * 10**6, "é" * 101)]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fingerprint string").repartition(5)
    got = {r.doc_id: r for r in fp.fingerprint_with_next(df).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, reverse=True)
    for k, (d, t) in enumerate(order):
        text, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        assert got[d].edited_sha256 == hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()
        assert got[d].n_chars == len(text) and 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
    long = [r for r in got.values() if r.n_chars > 1500]
    assert np.mean([r.near_edited for r in long]) > np.mean([r.near_next for r in long]) + 0.2


def test_repeated_rows_missing_ids_and_empty_tables(spark):
    rows = [(1, "alpha " * 40), (1, "alpha " * 40), (2, "beta"), (None, "gamma")]
    got = fp.fingerprint_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 1, 2]
    assert len({r.fingerprint for r in got if r.doc_id == 1}) == 1
    assert next(r for r in got if r.doc_id is None).edited_sha256 == hashlib.sha256(b"gambe").hexdigest()
    alone = fp.fingerprint_with_next(spark.createDataFrame([(7, "abcd")], "doc_id long, text string")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and alone.near_next == 1.0
    assert fp.fingerprint_with_next(spark.createDataFrame([], "doc_id long, text string")).count() == 0
