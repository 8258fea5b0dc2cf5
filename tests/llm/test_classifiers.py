import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strandlake.llm import langid, quality

STEMS = {"en": "the and with ing tion her ly ough wh", "de": "der und sch ung keit ich ver ein zu", "fr": "les des eau ment que oi une ç é", "es": "los que ción ado ñ ez mente ía del"}


def sentence(rng, lang, n):
    stems = STEMS[lang].split()
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        lang = rng.choice(sorted(STEMS))
        rows.append((i, sentence(rng, lang, rng.randint(4, 120)), lang if i % 9 else None, lang))
    return rows


def test_language_held_out_accuracy(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, lang, "x") for d, t, lang, _ in rows] + [(9000, None, "en", "x"), (9001, "123 ...", "de", "x"), (9002, "", None, "x"), (None, "the and with the", None, "x")], "doc_id long, text string, lang string, score string")
    model = langid.fit(df, sample_per_lang=60)
    assert set(model.groups) == {"germanic", "romance"}
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    assert len(got) == len(rows) + 4
    for d in (9000, 9001, 9002):
        assert (got[d].lang_pred, got[d].score) == ("und", 0.0)
    assert got[None].lang_pred == "en" and got[None].held_out is False
    truth = {d: t for d, _, _, t in rows}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2]
    assert all(got[d].held_out == (d in held) for d in truth)
    assert np.mean([got[d].lang_pred == truth[d] for d in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = langid.keep_identified(df, model)
    assert kept.columns == df.columns and kept.count() == len(rows) + 1


def test_language_doesnt_depend_on_the_batch(spark):
    rows = corpus()[:80]
    df = spark.createDataFrame([(d, t, lang) for d, t, lang, _ in rows], "doc_id long, text string, lang string")
    model = langid.fit(df)
    one = sorted(map(tuple, langid.identify(df.coalesce(1), model).collect()))
    many = sorted(map(tuple, langid.identify(df.repartition(7), model).collect()))
    assert [x[:3] for x in one] == [x[:3] for x in many] and np.allclose([x[3] for x in one], [x[3] for x in many])


def plain_margin(text, weights, bias):
    """A machine's margin of one text, feature by feature."""
    raw = text.lower().encode()
    half, total = len(weights) // 2, 0.0
    for i in range(len(raw) - 1):
        total += float(weights[(raw[i] << 8 | raw[i + 1]) % half])
    for i in range(len(raw) - 2):
        triple = raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]
        total += float(weights[half + ((triple * 2654435761 % (1 << 32)) >> 16) % half])
    return total / max(len(raw), 1) + bias


def plain_vote(model, level, classes, text):
    if len(classes) == 1:
        return classes[0], 1.0
    wins, total, likely = Counter(), Counter(), Counter()
    for (own, a, b), w, bias in zip(model.pairs, model.weights, model.biases, strict=True):
        if own == level:
            m = plain_margin(text, w, bias)
            p = 1 / (1 + math.exp(-4 * max(-9, min(9, m))))
            wins.update({a: int(m > 0), b: int(m < 0)})
            total.update({a: m, b: -m})
            likely.update({a: p, b: 1 - p})
    best = max(classes, key=lambda x: (wins[x], total[x]))
    return best, likely[best] / (len(classes) - 1)


@pytest.mark.parametrize("most_bytes", [langid.MOST_BYTES, 1 << 16])
def test_language_votes_against_brute_force(most_bytes):
    rows = corpus()[:120]
    counted = pa.RecordBatch.from_arrays([pa.array([lang for *_, lang in rows]), pa.array([t for _, t, _, _ in rows])], ["lang", "text"])
    made = next(langid.counted(iter([counted]))).to_pylist()
    parsed = [(r["lang"], np.frombuffer(r["keys"], "<i4"), np.frombuffer(r["shares"], "<f4").astype(float)) for r in made]
    model = langid.Model(langid.families(parsed), most_bytes).fit(parsed)
    assert model.weights.nbytes <= most_bytes
    texts = [t for _, t, _, _ in rows[:20]] + ["a", "Ünïcode \U0001d518", "the und les", "x" * 5000]
    named, score = model.predict(pa.array(texts))
    for text, lang, p in zip(texts, named, score, strict=True):
        family, q = plain_vote(model, "", list(model.groups), text)
        best, r = plain_vote(model, family, model.groups[family], text)
        assert lang == best and math.isclose(p, q * r, rel_tol=1e-5, abs_tol=1e-7)


def test_many_languages_make_few_families(spark):
    rng = random.Random(8)
    stems = {f"x{k:02}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(12)] for k in range(30)}
    rows = [(i, " ".join("".join(rng.choice(stems[lang]) for _ in range(2)) for _ in range(40)), lang) for i, lang in enumerate(sorted(stems) * 12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert len(model.groups) <= langid.MOST_CLASSES and max(map(len, model.groups.values())) <= langid.MOST_CLASSES
    assert sorted(x for langs in model.groups.values() for x in langs) == sorted(stems)
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    held = [(d, lang) for d, _, lang in rows if got[d].held_out]
    assert np.mean([got[d].lang_pred == lang for d, lang in held]) > 0.95


def test_language_without_labels(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert [(r.lang_pred, r.score) for r in langid.identify(df, model).collect()] == [("und", 0.0)]
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.identify(empty, langid.fit(empty)).count() == 0


def quality_rows(seed=4):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(800):
        good = rng.random() < 0.7
        text = sentence(rng, "en", rng.randint(10, 90)) if good else " ".join([sentence(rng, "en", 1)] * 40) if i % 2 else sentence(rng, "en", 40).upper().replace(" ", "!! ")
        rows.append((i, text, len(text) if i % 3 else None))
        if i % 5:
            labels.append((i, int(good), 0))
    return rows, labels


def test_quality_held_out(spark):
    rows, labels = quality_rows()
    df = spark.createDataFrame([*rows, (9000, None, None), (9001, "", 0), (None, "the and", 7)], "doc_id long, text string, n_chars long")
    lab = spark.createDataFrame([*labels, (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.score(df, quality.fit(df, lab, sample=400)).collect()}
    assert len(got) == len(rows) + 3 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [(got[d].score, q) for d, q, _ in labels if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, *_ in rows)
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert got[9000].score == got[9001].score


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3)
    m.linear, m.factors = rng.normal(size=m.linear.shape), rng.normal(size=m.factors.shape)
    bucket, value, stats = np.array([4, 9, 77]), np.array([0.5, 0.2, 0.9]), rng.normal(size=(1, len(quality.STATISTICS)))
    x = {**dict(zip(bucket.tolist(), value.tolist(), strict=True)), **{quality.BUCKETS + k: v for k, v in enumerate(m.standard(stats)[0])}}
    keys = sorted(x)
    want = 0.3 + sum(m.linear[k] * x[k] for k in keys) + sum(float(m.factors[a] @ m.factors[b]) * x[a] * x[b] for i, a in enumerate(keys) for b in keys[i + 1 :])
    assert np.isclose(m.raw(1, np.zeros(3, int), bucket, value, stats)[0], want)


def test_quality_without_labels(spark):
    df = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    lab = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.score(df, quality.fit(df, lab)).collect()] == [0.5]
    one = spark.createDataFrame([(2, 1), (3, 1), (1, 1)], "doc_id long, quality int")
    assert quality.score(df, quality.fit(df, one)).first().predicted in (0, 1)
    assert quality.score(df.limit(0), quality.Machine()).count() == 0
