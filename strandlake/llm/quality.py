"""A factorisation machine that scores the quality of a text.

Inputs are hashed words (shares of the text, normalised), structure statistics and the metadata field n_chars.
Pairwise interactions have rank ``FACTORS`` and are summed in linear time: half of the square of the sum less the
sum of squares. The machine is fitted on a bounded sample of labelled rows; its size is fixed, and it is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.langid import remainder
from strandlake.llm.runtime import prepare, sliced
from strandlake.llm.textbytes import chunks, lower_ascii, span_hashes, utf8, word_spans

BUCKETS, FACTORS = 1 << 15, 8
STATISTICS = ("upper", "digit", "mark", "blank", "line", "beyond_ascii", "word_size", "distinct_words", "top_word", "log_words", "log_chars")

_CLASS = np.full(256, 5, np.uint8)
_CLASS[:128] = 2
_CLASS[[*range(97, 123)]] = 6
_CLASS[[*range(65, 91)]] = 0
_CLASS[[*range(48, 58)]] = 1
_CLASS[[9, 11, 12, 13, 32]] = 3
_CLASS[10] = 4


def features(column: pa.Array, n_chars: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk of texts: first and last row, row, bucket and value of each word feature, and the statistics."""
    raw, offsets = utf8(column)
    for i, j in chunks(offsets):
        at = offsets[i : j + 1] - offsets[i]
        part = raw[offsets[i] : offsets[j]]
        n = j - i
        size = np.maximum(np.diff(at), 1)
        kinds = _CLASS[part]
        stats = np.zeros((n, len(STATISTICS)))
        for k in range(6):
            total = np.concatenate(([0], np.cumsum(kinds == k)))
            stats[:, k] = (total[at[1:]] - total[at[:-1]]) / size
        starts, ends, words = word_spans(part, at)
        bucket = (span_hashes(lower_ascii(part), starts, ends) >> np.uint64(49)).astype(np.int64)
        row = np.repeat(np.arange(n), words)
        key, times = np.unique(row * BUCKETS + bucket, return_counts=True)
        row, bucket = key // BUCKETS, key % BUCKETS
        norm = np.sqrt(np.bincount(row, times.astype(float) ** 2, minlength=n))
        top = np.zeros(n)
        np.maximum.at(top, row, times)
        some = np.maximum(words, 1)
        stats[:, 6] = np.bincount(np.repeat(np.arange(n), words), ends - starts, minlength=n) / some
        stats[:, 7] = np.bincount(row, minlength=n) / some
        stats[:, 8] = top / some
        stats[:, 9] = np.log1p(words)
        stats[:, 10] = np.log1p(n_chars[i:j])
        yield i, j, row, bucket, times / norm[row], stats


class Machine:
    """Weights for BUCKETS word features and then the statistics, which are standardised and clipped."""

    def __init__(self, constant: float = 0.0):
        total = BUCKETS + len(STATISTICS)
        self.constant, self.linear, self.factors = constant, np.zeros(total), np.zeros((total, FACTORS))
        self.mean, self.spread = np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))

    def standard(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.spread, -4, 4) / np.sqrt(len(STATISTICS))

    def raw(self, n: int, row: np.ndarray, bucket: np.ndarray, value: np.ndarray, stats: np.ndarray) -> np.ndarray:
        """The machine's sum before the logistic function."""
        x = self.standard(stats)
        lin, fac = self.linear, self.factors
        out = self.constant + np.bincount(row, lin[bucket] * value, minlength=n) + x @ lin[BUCKETS:]
        for f in range(FACTORS):
            term = fac[bucket, f] * value
            first = np.bincount(row, term, minlength=n) + x @ fac[BUCKETS:, f]
            second = np.bincount(row, term * term, minlength=n) + (x * x) @ (fac[BUCKETS:, f] ** 2)
            out += 0.5 * (first * first - second)
        return out

    def score(self, column: pa.Array, n_chars: np.ndarray) -> np.ndarray:
        out = np.zeros(len(column))
        for i, j, row, bucket, value, stats in features(column, n_chars):
            out[i:j] = self.raw(j - i, row, bucket, value, stats)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = 12, step: float = 0.02, shrink: float = 1e-4) -> Machine:
        """Adam on the logistic loss; rows are (buckets, values, statistics)."""
        stats = np.stack([s for *_, s in rows])
        self.mean, self.spread = stats.mean(0), stats.std(0) + 1e-6
        x_all = self.standard(stats)
        rng = np.random.Generator(np.random.PCG64(11))
        self.factors = rng.normal(0, 0.05, self.factors.shape)
        theta = np.concatenate((self.linear[:, None], self.factors), axis=1)
        m, v, t, order = np.zeros_like(theta), np.zeros_like(theta), 0, np.arange(len(rows))
        fixed = np.arange(BUCKETS, BUCKETS + len(STATISTICS))
        for _ in range(rounds):
            rng.shuffle(order)
            for at in range(0, len(order), 64):
                part = order[at : at + 64]
                n = len(part)
                row = np.concatenate([np.repeat(np.arange(n), [len(rows[i][0]) for i in part]), np.repeat(np.arange(n), len(fixed))])
                col = np.concatenate([*(rows[i][0] for i in part), np.tile(fixed, n)]).astype(np.int64)
                val = np.concatenate([*(rows[i][1] for i in part), x_all[part].ravel()])
                own = theta[col]
                term = own * val[:, None]
                both = np.stack([np.bincount(row, term[:, k], minlength=n) for k in range(FACTORS + 1)], axis=1)
                square = np.stack([np.bincount(row, term[:, k] ** 2, minlength=n) for k in range(1, FACTORS + 1)], axis=1)
                z = self.constant + both[:, 0] + 0.5 * (both[:, 1:] ** 2 - square).sum(1)
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]) / n
                grad = np.empty_like(own)
                grad[:, 0] = error[row] * val
                grad[:, 1:] = (error[row] * val)[:, None] * (both[row, 1:] - term[:, 1:])
                used, inverse = np.unique(col, return_inverse=True)
                g = np.stack([np.bincount(inverse, grad[:, k], minlength=len(used)) for k in range(FACTORS + 1)], axis=1) + shrink * theta[used]
                t += 1
                m[used] = 0.9 * m[used] + 0.1 * g
                v[used] = 0.999 * v[used] + 0.001 * g * g
                theta[used] -= step * (m[used] / (1 - 0.9**t)) / (np.sqrt(v[used] / (1 - 0.999**t)) + 1e-8)
                self.constant -= step * float(error.sum())
        self.linear, self.factors = theta[:, 0].copy(), theta[:, 1:].copy()
        return self


def _lengths(column: pa.Array) -> np.ndarray:
    return np.maximum(np.nan_to_num(column.cast(pa.float64()).to_numpy(zero_copy_only=False)), 0)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text, n_chars) to sparse training rows."""
    for batch in sliced(batches):
        out = []
        for i, j, row, bucket, value, stats in features(batch.column(1), _lengths(batch.column(2))):
            cut = np.searchsorted(row, np.arange(j - i + 1))
            out += [(bucket[a:b].astype("<i4").tobytes(), value[a:b].astype("<f4").tobytes(), s.astype("<f8").tobytes()) for a, b, s in zip(cut[:-1], cut[1:], stats, strict=True)]
        columns = zip(*out, strict=True) if out else ([], [], [])
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.binary()) for c in columns)], ["label", "buckets", "vals", "stats"])


def _measured(docs: DataFrame, text_col: str, length_col: str | None) -> list:
    """The text and its length: the metadata field, where it is there and set, else counted."""
    counted_length = F.length(F.coalesce(F.col(text_col), F.lit("")))
    known = F.coalesce(F.col(length_col).cast("double"), counted_length.cast("double")) if length_col and length_col in docs.columns else counted_length.cast("double")
    return [F.col(text_col).alias("text"), known.alias("n_chars")]


def fit(docs: DataFrame, labels: DataFrame, sample: int = 3000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", length_col: str | None = "n_chars") -> Machine:
    """Learns from labelled rows whose CRC-32 of doc_id isn't 1 modulo 3, about ``sample`` of them by a hash of
    doc_id. Without labels the score is 0.5; with labels of one kind it is that kind's."""
    spark = docs.sparkSession
    prepare(spark)
    usable = labels.select(F.col(id_col).alias("d"), F.col(label_col).cast("double").alias("label"), F.xxhash64(id_col, F.lit("sample")).alias("u")).filter(F.col("label").isNotNull() & (remainder("d", 3) != 1))
    n = usable.count()
    if not n:
        return Machine()
    picked = usable.filter((F.shiftrightunsigned("u", 11) / float(1 << 53)) < min(1.0, sample / n)).groupBy("d").agg(F.max("label").alias("label"))
    rows = docs.select(F.col(id_col).alias("d"), *_measured(docs, text_col, length_col)).join(F.broadcast(picked), "d").select("label", "text", "n_chars").mapInArrow(counted, "label double, buckets binary, vals binary, stats binary").collect()
    rows = sorted((bytes(r["stats"]), bytes(r["buckets"]), bytes(r["vals"]), r["label"]) for r in rows)
    y = np.array([r[-1] for r in rows])
    if not len(y) or y.min() == y.max():
        return Machine(0.0 if not len(y) else 4.0 * (2 * y[0] - 1))
    return Machine().fit([(np.frombuffer(b, "<i4"), np.frombuffer(v, "<f4").astype(float), np.frombuffer(s, "<f8")) for s, b, v, _ in rows], y)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """One row per row: doc_id, held_out, score, predicted. A null text counts as empty and is scored too; a null
    doc_id counts as not held out. Repeated rows give repeated rows, no rows none."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            s = shared.value.score(batch.column(2), _lengths(batch.column(3)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    held_out = F.coalesce(remainder(id_col, 3) == 1, F.lit(False))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), *_measured(docs, text_col, length_col)).mapInArrow(work, "doc_id long, held_out boolean, score double, predicted int")
