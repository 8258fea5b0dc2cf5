"""Improbable-feature digests of texts, in chained Bloom filters.

A feature is a window of 16 bytes; zeros stand before a text, so the first windows are its beginnings, and every text
has as many windows as bytes. A window's rank is how rare the entropy of its bytes is among all windows of the corpus;
windows of few different bytes (long runs) come after all others. In each stretch of 16 consecutive windows, shorter at
the ends of a text, the rarest one (leftmost on ties) gains a point; windows with enough points are selected. The
rarest window of a text stands in 16 stretches, so every text but the empty one has a feature. Their hashes go into
Bloom filters of 256 bytes, a new one after every 160 features; a last filter less than half full is merged into the
one before. Two digests are compared filter by filter: the bits they share, less those the best of the other's
filters shares by chance, over the most they could share. A filter too sparse to tell the two apart shares nothing.
The same rule holds for texts of every length.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import prepare, sliced
from strandlake.llm.textbytes import chunks, mix64, powers, utf8

WINDOW, STRETCH, POINTS = 16, 16, 2
#: Zeros before a text: as many as keep windows and stretches from spanning two texts.
PAD = max(WINDOW, STRETCH) - 1
CLASSES = 1024
FILTER_BYTES, FILTER_FEATURES, HASHES = 256, 160, 5
#: A comparison needs room of so many standard deviations.
ROOM = 4

_C_LOG_C = np.zeros(WINDOW + 2, np.int32)
_C_LOG_C[1:] = np.round(1024 * np.arange(1, WINDOW + 2) * np.log2(np.arange(1, WINDOW + 2))).astype(np.int32)
_TOP = int(_C_LOG_C[WINDOW])
_HASH = powers(np.uint64(0x9E3779B97F4A7C15), WINDOW)


def entropy_classes(raw: np.ndarray) -> np.ndarray:
    """For each window its entropy in CLASSES steps. The counts of a byte within the windows that begin and end at
    it come from comparing the bytes with themselves, shifted; the sum of c log c then moves by two table entries."""
    n = len(raw) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int16)
    ahead = np.ones(len(raw), np.uint8)
    behind = np.ones(len(raw), np.uint8)
    for s in range(1, WINDOW):
        same = (raw[:-s] == raw[s:]).view(np.uint8)
        ahead[:-s] += same
        behind[s:] += same
    start = int(_C_LOG_C[np.bincount(raw[:WINDOW], minlength=256)].sum())
    out_of, into = ahead[: n - 1], behind[WINDOW:]
    # leaving at i: its count within [i, i + 64); coming at i + 64: its count within [i + 1, i + 65)
    change = (_C_LOG_C[out_of - 1] - _C_LOG_C[out_of]) + (_C_LOG_C[into] - _C_LOG_C[into - 1])
    total = np.concatenate(([start], start + np.cumsum(change, dtype=np.int64)))
    return ((_TOP - total) * (CLASSES - 1) // _TOP).astype(np.int16)


def blocks(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of texts with zeros before each: the bytes, and where the zeros of each text begin (and the end)."""
    for i, j in chunks(offsets, 1 << 17):
        size = np.diff(offsets[i : j + 1])
        at = np.concatenate(([0], np.cumsum(size + PAD)))
        out = np.zeros(int(at[-1]), np.uint8)
        out[np.arange(offsets[j] - offsets[i]) + np.repeat(PAD * np.arange(1, j - i + 1), size)] = raw[offsets[i] : offsets[j]]
        yield out, at


def in_one_text(n: int, at: np.ndarray) -> np.ndarray:
    """Which of n windows end within a text, so that zeros or its own bytes stand before."""
    inside = np.zeros(n + 1, np.int32)
    lo, hi = at[:-1] + PAD + 1 - WINDOW, at[1:] + 1 - WINDOW
    some = hi > lo
    np.add.at(inside, lo[some], 1)
    np.add.at(inside, hi[some], -1)
    return np.cumsum(inside[:n]) > 0


def histogram(column: pa.Array) -> np.ndarray:
    raw, offsets = utf8(column)
    out = np.zeros(CLASSES, np.int64)
    for part, at in blocks(raw, offsets):
        c = entropy_classes(part)
        out += np.bincount(c[in_one_text(len(c), at)], minlength=CLASSES)
    return out


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each class: the rarer, the smaller. The lowest classes (long runs) come last."""
    order = np.argsort(np.argsort(counts, kind="stable"), kind="stable").astype(np.int64)
    order[: CLASSES // 8] += CLASSES
    return order


def selected(raw: np.ndarray, at: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Positions of the windows with enough points."""
    classes = entropy_classes(raw)
    n = len(classes)
    if not n:
        return np.empty(0, np.int64)
    worst = np.int64(1 << 20)
    least = np.where(in_one_text(n, at), ranks[classes], worst) << np.int64(32) | np.arange(n, dtype=np.int64)
    # PAD invalid windows part two texts, and here the ends, so no stretch has valid ones of two texts
    least = np.pad(least, STRETCH - 1, constant_values=worst << np.int64(32))
    width = 1
    while width < STRETCH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    points = np.bincount(least[least < worst << np.int64(32)] & np.int64(0xFFFFFFFF), minlength=n)
    return np.flatnonzero(points >= POINTS)


def window_hashes(raw: np.ndarray, positions: np.ndarray) -> np.ndarray:
    out = np.zeros(len(positions), np.uint64)
    for k in range(WINDOW):
        out += (raw[positions + k].astype(np.uint64) + np.uint64(1)) * _HASH[k]
    return mix64(out)


class Digest:
    """Chained filters, packed bits, and the number of set bits of each."""

    __slots__ = ("bits", "ones", "features")

    def __init__(self, hashes: np.ndarray):
        self.features = len(hashes)
        made = []
        starts = list(range(0, len(hashes), FILTER_FEATURES))
        if len(starts) > 1 and len(hashes) - starts[-1] < FILTER_FEATURES // 2:
            starts.pop()
        for lo, hi in zip(starts, [*starts[1:], len(hashes)], strict=False):
            part = hashes[lo:hi]
            flags = np.zeros(FILTER_BYTES * 8, np.uint8)
            for k in range(HASHES):
                flags[((part >> np.uint64(11 * k)) & np.uint64(2047)).astype(np.int64)] = 1
            made.append(np.packbits(flags))
        self.bits = np.stack(made) if made else np.zeros((0, FILTER_BYTES), np.uint8)
        self.ones = np.bitwise_count(self.bits).sum(1).astype(float)

    def text(self) -> str:
        return f"{self.features}:{base64.b64encode(self.bits.tobytes()).decode()}" if self.features else ""

    def likeness(self, other: Digest) -> float:
        if not self.features or not other.features:
            return float(self.features == other.features)
        a, b = (self, other) if len(self.ones) <= len(other.ones) else (other, self)
        size = FILTER_BYTES * 8
        best = math.sqrt(2 * math.log(len(b.ones)))  # standard deviations that the best of so many is above the mean
        total = 0.0
        for bits, ones in zip(a.bits, a.ones, strict=True):
            shared = np.bitwise_count(bits & b.bits).sum(1)
            most = np.minimum(ones, b.ones)
            spread = np.sqrt(ones * b.ones / size * (1 - b.ones / size) * (1 - ones / size))
            chance = ones * b.ones / size + best * spread
            room = most - chance
            total += float(np.where(room >= ROOM * spread, np.clip((shared - chance) / np.maximum(room, 1e-9), 0, 1), 0).max())
        return total / len(a.ones)


def digests(texts: list[str], ranks: np.ndarray) -> list[Digest]:
    raw, offsets = utf8(pa.array(texts, pa.large_string()))
    out: list[Digest] = []
    for part, at in blocks(raw, offsets):
        places = selected(part, at, ranks)
        hashes = window_hashes(part, places)
        # a text's windows begin before its own bytes
        cut = np.searchsorted(places, at)
        out.extend(Digest(hashes[lo:hi]) for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
    return out


def corpus_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts the entropy classes of all windows of all texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, np.int64)
        for batch in sliced(batches):
            total += histogram(batch.column(0))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["class", "n"])

    prepare(docs.sparkSession)
    counts = np.zeros(CLASSES, np.int64)
    for r in docs.select(F.col(text_col).alias("text")).mapInArrow(work, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():
        counts[r["class"]] = r["n"]
    return ranks_of(counts)


def cuts_below(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are below the value, in about twice the square root of their number of steps."""
    if not cuts:
        return F.lit(0)
    step = max(1, math.isqrt(len(cuts)))
    fine, coarse = F.array(*[F.lit(c).cast("long") for c in cuts]), F.array(*[F.lit(c).cast("long") for c in cuts[::step]])
    whole = F.size(F.filter(coarse, lambda c: c < value)) - 1
    return F.when(whole < 0, 0).otherwise(whole * step + F.size(F.filter(F.slice(fine, whole * step + 1, step), lambda c: c < value)))


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as many first code points of the following one (or all)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its digest, that of its edited text, and its likeness to that and to the next document's.

    The next document is the one with the next smaller doc_id, after the last the first; rows that share a doc_id
    follow in the order of their texts, rows without one come last. One document alone is its own next. A null text
    counts as empty, its digest is empty, and two empty digests are alike (1). No rows give none.

    The texts are shuffled once, into ranges of doc_id; the first row of each range goes to the range before, too.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(corpus_ranks(docs, text_col))
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("d"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted({int(c) for c in base.approxQuantile("d", [k / parts for k in range(1, parts)], 0.1 / parts)})
    base = base.withColumn("range", F.lit(len(cuts)) - cuts_below(F.col("d"), cuts))
    heads = sorted((r["range"], r["d"]) for r in base.groupBy("range").agg(F.max("d").alias("d")).collect())
    before = {r: (d, heads[k - 1][0]) for k, (r, d) in enumerate(heads)}
    if not before:
        return spark.createDataFrame([], SCHEMA)
    guests = F.create_map(*[x for r, (d, to) in before.items() for x in (F.lit(r), F.struct(F.lit(d).cast("long").alias("d"), F.lit(to).alias("to")))])
    mine = F.element_at(guests, F.col("range"))
    own = F.struct(F.col("range").alias("to"), F.lit(0).alias("guest"))
    target = F.when(mine["d"] == F.col("d"), F.array(own, F.struct(mine["to"].alias("to"), F.lit(1).alias("guest")))).otherwise(F.array(own))
    rows = base.select("d", "doc_id", "text", F.explode(target).alias("g")).select(F.col("g.to").alias("to"), F.col("g.guest").alias("guest"), "d", "doc_id", "text")
    rows = rows.repartition("to").sortWithinPartitions("to", "guest", F.desc("d"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row before, which waits for its next
        closed = -1  # the range whose guest was met
        for batch in sliced(batches):
            to, guest, doc_id, texts = (batch.column(n).to_pylist() for n in ("to", "guest", "doc_id", "text"))
            known = digests(texts, ranks.value)
            pairs = []
            for r, g, i, t, f in zip(to, guest, doc_id, texts, known, strict=True):
                if g and r == closed:
                    continue
                if held is not None and held[0] == r:
                    pairs.append((held, t, f))
                closed = r if g else closed
                held = None if g else (r, i, t, f)
            if not pairs:
                continue
            changed = [edited(h[2], t) for h, t, _ in pairs]
            prints = digests(changed, ranks.value)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([h[1] for h, *_ in pairs], pa.int64()),
                    pa.array([len(h[2]) for h, *_ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
                    pa.array([h[3].text() for h, *_ in pairs], pa.string()),
                    pa.array([p.text() for p in prints], pa.string()),
                    pa.array([h[3].likeness(p) for (h, *_), p in zip(pairs, prints, strict=True)], pa.float64()),
                    pa.array([h[3].likeness(f) for h, _, f in pairs], pa.float64()),
                ],
                [x.split()[0] for x in SCHEMA.split(", ")],
            )

    return rows.mapInArrow(work, SCHEMA)
