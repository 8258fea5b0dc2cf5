"""Language identification in two levels: the family first, then the language within it.

Both levels use one-versus-one linear support vector machines over hashed byte pairs and triples of the lower-cased
text, as shares of its length, so a score is a mean of weights and a text of any length is read once and whole.
The machines are fitted on a bounded sample of labelled rows (``sample_per_lang``) by dual coordinate descent. Only the
weights are broadcast, at most MOST_BYTES: the more machines there are, the fewer hashes each has. The machines of a
family read only the texts of that family.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import prepare, sliced
from strandlake.llm.textbytes import chunks, utf8

#: Families of the languages met most; the others are put into families by likeness.
FAMILIES = {
    "germanic": ("de", "nl", "en", "af", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "pt", "it", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "bg", "pl", "cs", "sk", "sl", "hr", "sr"),
}
HALF = 1 << 16
UNDETERMINED = "und"
#: Families, and languages of a family made by likeness; bytes of all weights.
MOST_CLASSES = 16
MOST_BYTES = 1 << 27


def grams(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of the byte pairs and triples that begin at each byte, and which of them stay in one text."""
    x = raw.astype(np.uint32)
    x1, x2 = np.append(x[1:], 0).astype(np.uint32), np.append(x[2:], (0, 0)[: min(2, len(x))]).astype(np.uint32)
    pair = (x << np.uint32(8)) | x1
    triple = (((pair << np.uint32(8)) | x2) * np.uint32(2654435761)) >> np.uint32(16)
    ends = at[1:][np.diff(at) > 0]
    in_pair = np.ones(len(x), bool)
    in_pair[ends - 1] = False
    in_triple = in_pair.copy()
    in_triple[np.maximum(ends - 2, 0)] = False
    return pair.astype(np.int32), triple.astype(np.int32) + HALF, in_pair, in_triple


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[at[1:]] - total[at[:-1]]


def lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return utf8(pc.utf8_lower(column.cast(pa.large_string())))


def folded(keys: np.ndarray, half: int) -> np.ndarray:
    """Feature numbers where pairs and triples have ``half`` numbers each, a power of two up to HALF."""
    return (keys & (half - 1)) + np.where(keys >= HALF, half, 0).astype(keys.dtype)


def margins(column: pa.Array, weights: np.ndarray, biases: np.ndarray) -> np.ndarray:
    """One row per text, one column per machine."""
    raw, offsets = lowered(column)
    half = weights.shape[1] // 2
    out = np.zeros((len(column), len(weights)))
    for i, j in chunks(offsets):
        at = offsets[i : j + 1] - offsets[i]
        if not at[-1]:
            continue
        pair, triple, in_pair, in_triple = grams(raw[offsets[i] : offsets[j]], at)
        pair, triple = folded(pair, half), folded(triple, half)
        size = np.maximum(np.diff(at), 1)
        for m, w in enumerate(weights):
            out[i:j, m] = sums(w[pair] * in_pair + w[triple] * in_triple, at) / size
    return out + biases


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, feature numbers, shares): sparse training rows."""
    for batch in sliced(batches):
        raw, offsets = lowered(batch.column(1))
        keys, values = [], []
        for i in range(len(offsets) - 1):
            own = raw[offsets[i] : offsets[i + 1]]
            pair, triple, in_pair, in_triple = grams(own, np.array([0, len(own)]))
            key, n = np.unique(np.concatenate((pair[in_pair], triple[in_triple])), return_counts=True)
            keys.append(key.astype("<i4").tobytes())
            values.append((n / max(len(own), 1)).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(values, pa.binary())], ["lang", "keys", "shares"])


def fit_machine(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, half: int = HALF, c: float = 10.0, rounds: int = 20) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, by dual coordinate descent. The last weight is the bias."""
    scale = 1.0 / np.sqrt(np.mean([float(v @ v) for _, v in rows]) or 1.0)
    w = np.zeros(2 * half + 1)
    alpha = np.zeros(len(rows))
    norms = np.array([scale * scale * float(v @ v) + 1.0 for _, v in rows])
    order, rng = np.arange(len(rows)), np.random.Generator(np.random.PCG64(7))
    for _ in range(rounds):
        rng.shuffle(order)
        for i in order:
            k, v = rows[i]
            g = signs[i] * (scale * float(w[k] @ v) + w[-1]) - 1.0 + alpha[i] / (2 * c)
            new = max(alpha[i] - g / (norms[i] + 1 / (2 * c)), 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * signs[i]
                w[k] += step * scale * v
                w[-1] += step
                alpha[i] = new
    return (w[:-1] * scale).astype(np.float32), float(w[-1])


def families(rows: list[tuple[str, np.ndarray, np.ndarray]], most: int = MOST_CLASSES) -> dict[str, str]:
    """The family of each language of the rows: one of FAMILIES or, for the other languages, one of its own. While there
    are more than ``most``, the two most alike of those made here are joined, to at most ``most`` languages; a joined
    family has the name of its first language."""
    langs = sorted({lang for lang, *_ in rows})
    found = {lang: next((f for f, members in FAMILIES.items() if lang in members), lang) for lang in langs}
    made = [lang for lang in langs if found[lang] == lang]
    groups = [[lang] for lang in made]
    if len(set(found.values())) <= most:
        return found
    mean = np.zeros((len(made), 2 * HALF), np.float32)
    for lang, k, v in rows:
        if found[lang] == lang:
            mean[made.index(lang), k] += v
    mean /= np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-12)
    alike, at = mean @ mean.T, {lang: i for i, lang in enumerate(made)}

    def likeness(pair: tuple[list[str], list[str]]) -> float:
        return float(np.mean(alike[np.ix_([at[x] for x in pair[0]], [at[x] for x in pair[1]])]))

    while len(groups) + len(set(found.values()) & set(FAMILIES)) > most:
        pairs = [(a, b) for a, b in combinations(groups, 2) if len(a) + len(b) <= most]
        if not pairs:
            break
        a, b = max(pairs, key=likeness)
        groups = [g for g in groups if g is not a and g is not b] + [sorted(a + b)]
    return found | {lang: group[0] for group in groups for lang in group}


class Model:
    """Machines for pairs of families and for pairs of languages of one family."""

    def __init__(self, family: dict[str, str], most_bytes: int = MOST_BYTES):
        self.family = family
        self.groups = {f: sorted(x for x in family if family[x] == f) for f in sorted(set(family.values()))}
        self.pairs: list[tuple[str, str, str]] = [("", a, b) for a, b in combinations(self.groups, 2)]
        self.pairs += [(f, a, b) for f, members in self.groups.items() for a, b in combinations(members, 2)]
        self.half = HALF
        while self.half > 1 << 8 and len(self.pairs) * 2 * self.half * 4 > most_bytes:
            self.half //= 2
        self.weights, self.biases = np.zeros((0, 2 * self.half), np.float32), np.zeros(0)

    def fit(self, rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
        def merged(keys: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            key, place = np.unique(folded(keys, self.half), return_inverse=True)
            return key, np.bincount(place, weights=shares, minlength=len(key))

        small = [(lang, *merged(k, v)) for lang, k, v in rows]
        made = []
        for level, a, b in self.pairs:
            named = {lang: lang if level else self.family[lang] for lang in self.family}
            own = [(k, v, 1.0 if named[lang] == a else -1.0) for lang, k, v in small if named[lang] in (a, b)]
            made.append(fit_machine([(k, v) for k, v, _ in own], np.array([x for *_, x in own]), self.half))
        if made:
            self.weights, self.biases = np.stack([w for w, _ in made]), np.array([b for _, b in made])
        return self

    def _vote(self, level: str, classes: list[str], column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of the class with most wins (ties: the larger sum of margins), and its mean likelihood."""
        n = len(column)
        if len(classes) == 1:
            return np.zeros(n, int), np.ones(n)
        own = [m for m, (of, _, _) in enumerate(self.pairs) if of == level]
        margin = margins(column, self.weights[own], self.biases[own])
        wins, total, likely = (np.zeros((n, len(classes))) for _ in range(3))
        for at, m in enumerate(own):
            p = 1 / (1 + np.exp(-4 * np.clip(margin[:, at], -9, 9)))
            for name, sign, q in ((self.pairs[m][1], 1, p), (self.pairs[m][2], -1, 1 - p)):
                x = classes.index(name)
                wins[:, x] += sign * margin[:, at] > 0
                total[:, x] += sign * margin[:, at]
                likely[:, x] += q / (len(classes) - 1)
        best = np.argmax(wins + 1e-3 * np.tanh(total), axis=1)
        return best, likely[np.arange(n), best]

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        n = len(column)
        named, score = np.full(n, UNDETERMINED, object), np.zeros(n)
        if self.groups:
            family, p = self._vote("", list(self.groups), column)
            for f, (name, langs) in enumerate(self.groups.items()):
                rows = np.flatnonzero(family == f)
                if len(rows):
                    best, q = self._vote(name, langs, column.take(pa.array(rows)))
                    named[rows], score[rows] = np.array(langs, object)[best], p[rows] * q
        lettered = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        named[~lettered], score[~lettered] = UNDETERMINED, 0.0
        return named.tolist(), score


def remainder(id_col: str, k: int) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % k


def fit(docs: DataFrame, sample_per_lang: int = 250, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from rows with a language, a text and a doc_id whose CRC-32 isn't 2 modulo 4; of each language about
    ``sample_per_lang`` of them, chosen by a hash of doc_id."""
    spark = docs.sparkSession
    prepare(spark)
    usable = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col, F.lit("sample")).alias("u"), remainder(id_col, 4).alias("r"))
    usable = usable.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("r") != 2))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return Model({})
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, sample_per_lang / n)))])
    picked = usable.filter((F.shiftrightunsigned("u", 11) / float(1 << 53)) < F.element_at(share, F.col("lang")))
    rows = picked.select("lang", "text").mapInArrow(counted, "lang string, keys binary, shares binary").collect()
    rows = sorted((r["lang"], bytes(r["keys"]), bytes(r["shares"])) for r in rows)
    parsed = [(lang, np.frombuffer(k, "<i4"), np.frombuffer(v, "<f4").astype(float)) for lang, k, v in rows if k]
    return Model(families(parsed)).fit(parsed)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, held_out, lang_pred, score (0 to 1).

    ``und`` with score 0 where the text is null or has no letter, or where no language was learned. A null doc_id
    counts as not held out. Repeated rows give repeated rows, no rows none.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            named, score = shared.value.predict(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(named, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    held_out = F.coalesce(remainder(id_col, 4) == 2, F.lit(False))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).alias("text")).mapInArrow(work, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.0, text_col: str = "text") -> DataFrame:
    """The rows whose language is determined with a score above ``least``, with all their columns."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            named, score = shared.value.predict(batch.column(text_col))
            yield batch.filter(pa.array([x != UNDETERMINED and s > least for x, s in zip(named, score, strict=True)], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
