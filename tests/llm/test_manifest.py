import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from strandlake.llm import manifest
from strandlake.llm.manifest import build, verify

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, path string, tree int"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(*now[i : i + 2]) for i in range(0, len(now), 2)])
    return levels


def way(levels, at):
    """(slot, siblings) up from a node."""
    out = []
    for level in levels[:-1]:
        run = level[at - at % 2 : at - at % 2 + 2]
        out.append((at % 2, run[:at % 2] + run[at % 2 + 1 :]))
        at //= 2
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(("" if r[2] is None else "1" + r[2]).encode(), []).append((r[0] is not None, r[0] or 0, leaf(*r[:5]), r))
    names = sorted(groups)
    trees = {n: climb([x[2] for x in sorted(groups[n], key=lambda x: x[:3])]) for n in names}
    top = climb([trees[n][-1][0] for n in names])
    out = []
    for k, n in enumerate(names):
        for at, (_, _, own, r) in enumerate(sorted(groups[n], key=lambda x: x[:3])):
            path = way(trees[n], at) + way(top, k)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now = leaf(*r[:3], r[3] if r[3] is None else r[3] + 1, r[4]) if tampered else own
            for slot, others in path:
                now = h(*others, now) if slot else h(now, *others)
            out.append((r[0], own, trees[n][-1][0], top[-1][0], h(*[s for _, others in path for s in others]), now, now == top[-1][0]))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = verify(df, tampered, {"n_chars": F.col("n_chars") + 1}, FIELDS, "lang")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def row(i, lang, text, source="s", n=None):
    return (i, source, lang, n if n is not None else (None if text is None else len(text)), text, "x", "y", 1)


@pytest.mark.parametrize("sizes", [(1,), (2,), (3,), (1, 1), (1, 2, 3), (255, 1), (257, 0, 5), (600, 300, 3, 1)])
def test_sizes(spark, sizes):
    rows = [row(1000 * k + i, f"l{k}", f"text {i}") for k, n in enumerate(sizes) for i in range(n)]
    assert run(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_odd_texts(spark):
    rows = [row(i, lang, text) for i, (lang, text) in enumerate([(None, None), (None, "a"), ("", ""), ("é", "ü" * 100_000), ("z", "a:b"), ("Z", "-"), ("zz", None)] * 5)]
    rows += [row(7, "z", "same")] * 6 + [row(7, "z", t) for t in "abc"] + [row(None, "z", "no id"), row(None, None, None)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False}


def test_null_length_is_not_tampered(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 0]
    rows = [(i, "s", "en", None if i == ids[0] else 3, "abc", "x", "y", 1) for i in ids]
    assert {r[0]: r[6] for r in run(spark, rows)} == {i: i == ids[0] for i in ids}


def test_more_than_two_stages(spark, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", 2)
    rows = [row(i, "en" if i % 3 else f"l{i:04}", f"t{i}") for i in range(100)]
    assert run(spark, rows) == brute(rows)


def test_preimages_hash_to_their_parents(spark, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", 3)
    rows = [row(i, "en", f"t{i}") for i in range(75)]
    made = build(spark.createDataFrame(rows, SCHEMA), FIELDS, "lang", "doc_id")
    levels = climb([leaf(*r[:5]) for r in rows])
    want = {(k + 1, i): "".join(level[2 * i : 2 * i + 2]) for k, level in enumerate(levels[:-1]) for i in range(-(-len(level) // 2))}
    assert {(r.level, r.node): r.preimage for r in made.preimages().collect()} == want


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert verify(df, F.lit(True), {}, FIELDS, "lang").collect() == []
    assert build(df, FIELDS, "lang", "doc_id") is None
