"""Telling the type and strand of sequences that come without one, by the k-mers of the references.

An index holds every k-mer of every reference as a number, sorted, with the types that have it. A query's k-mers are
looked up as they are (strand +) and reverse-complemented (strand -). Every position whose k-mer a type has is a hit of
that type and strand, counted for each of a few segments of the query:

* most hits in all tell the type and strand; ties go to the first type by name, then to strand +;
* ``unrecognizable``: hardly any hits;
* ``chimeric``: in some segment another type or strand leads clearly;
* ``unresolvable``: another type has nearly as many hits;
* ``unusually long``: far longer than the type's longest reference;
* else ``classified``.

An index of a checked size is broadcast and searched in Arrow batches. A larger one stays a table, which the queries'
k-mers are joined to; the answers are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.iupac import reverse_complement
from strandlake.sources.config import Reference

ADDED = {"classified": pa.string(), "strand": pa.string(), "status": pa.string(), "hits": pa.int64(), "kmers": pa.int64(), "taxa": pa.list_(pa.string())}
ADDED_DDL = "classified string, strand string, status string, hits long, kmers long, taxa array<string>"
#: Bytes of an index that is sent to the executors.
MOST_BYTES = 1 << 28
STRANDS = "+-"

_BASE = np.full(256, 4, np.uint8)
for _i, _letters in enumerate(("Aa", "Cc", "Gg", "TtUu")):
    for _c in _letters:
        _BASE[ord(_c)] = _i


@dataclass(frozen=True)
class Thresholds:
    """In percent but for ``segments`` and ``clearly``: hits of all k-mers that a type needs, of those of a segment that
    its leader needs; how many times the type's hits the leader of a segment must have; hits of the best type that
    another may have; length of the longest reference that a query may have."""

    least: int = 5
    segments: int = 4
    of_segment: int = 20
    clearly: int = 2
    nearly: int = 90
    longest: int = 125


def kmers(seq: str, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the k-mers of a sequence, of their reverse complements, and which have no other letters than ACGTU."""
    bases = _BASE[np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)]
    n = len(bases) - k + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, bool)
    plus, minus, good = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(k):
        part = bases[i : i + n]
        good &= part < 4
        two = (part & 3).astype(np.uint64)
        plus = (plus << np.uint64(2)) | two
        minus |= (np.uint64(3) - two) << np.uint64(2 * i)
    return plus, minus, good


@dataclass(frozen=True)
class KmerIndex:
    """``numbers`` are sorted and distinct; ``members[first[i]:first[i + 1]]`` are the types that have number i."""

    k: int
    ctypes: tuple[str, ...]
    longest: tuple[int, ...]
    numbers: np.ndarray
    first: np.ndarray
    members: np.ndarray

    @classmethod
    def of(cls, references: Iterable[Reference], k: int = 13) -> KmerIndex:
        if not 1 <= k <= 31:
            raise ValueError("k must be from 1 to 31")
        references = list(references)
        ctypes = tuple(sorted({r.ctype for r in references}))
        number = {c: i for i, c in enumerate(ctypes)}
        longest = [0] * len(ctypes)
        made, own = [np.empty(0, np.uint64)], [np.empty(0, np.int32)]
        for r in references:
            plus, _, good = kmers(r.seq, k)
            made.append(np.unique(plus[good]))
            own.append(np.full(len(made[-1]), number[r.ctype], np.int32))
            longest[number[r.ctype]] = max(longest[number[r.ctype]], len(r.seq))
        pairs = np.unique(np.rec.fromarrays((np.concatenate(made), np.concatenate(own)), names="kmer,ctype"))
        numbers, first = np.unique(pairs.kmer, return_index=True)
        return cls(k, ctypes, tuple(longest), numbers, np.append(first, len(pairs)), np.ascontiguousarray(pairs.ctype))

    def nbytes(self) -> int:
        return self.numbers.nbytes + self.first.nbytes + self.members.nbytes

    def table(self, spark: SparkSession) -> DataFrame:
        """(kmer, ctype), the k-mers as numbers."""
        made = pa.table({"kmer": self.numbers.astype(np.int64).repeat(np.diff(self.first)), "ctype": self.members})
        return spark.createDataFrame(made)

    def hits(self, seqs: list[str], segments: int) -> tuple[np.ndarray, np.ndarray]:
        """Hits of each sequence by strand, type and segment, and the k-mers of each of its segments. All sequences are
        looked up together: joined by letters that no k-mer has."""
        plus, minus, good = kmers("-".join(seqs), self.k)
        sizes = np.array([len(s) for s in seqs])
        counts = np.maximum(sizes - self.k + 1, 0)
        owner = np.repeat(np.arange(len(seqs)), sizes + 1)[: len(plus)]
        at = np.arange(len(plus)) - np.repeat(np.cumsum(sizes + 1) - (sizes + 1), sizes + 1)[: len(plus)]
        cells = owner * segments + np.minimum(at * segments // np.maximum(counts, 1)[owner], segments - 1)
        valid = np.bincount(cells[good], minlength=len(seqs) * segments).reshape(-1, segments)
        per_seq, types = len(self.ctypes) * segments, np.diff(self.first)
        out = np.zeros((len(seqs), 2, len(self.ctypes), segments), np.int64)
        for strand, numbers in enumerate((plus, minus)):
            place = np.searchsorted(self.numbers, numbers)
            found = np.flatnonzero(good & (place < len(self.numbers)))
            found = found[self.numbers[place[found]] == numbers[found]]
            lo, many = self.first[place[found]], types[place[found]]
            each = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
            own, segment = np.divmod(np.repeat(cells[found], many), segments)
            cell = own * per_seq + self.members[each] * segments + segment
            out[:, strand] = np.bincount(cell, minlength=len(seqs) * per_seq).reshape(len(seqs), -1, segments)
        return out, valid


def decide(hits: np.ndarray, valid: np.ndarray, lengths: list[int], ctypes: tuple[str, ...], longest: tuple[int, ...], t: Thresholds) -> list[tuple]:
    """The values of ADDED for each sequence."""
    counts = valid.sum(axis=1)
    if not len(ctypes):
        return [(None, None, "unrecognizable", 0, n, []) for n in counts.tolist()]
    # types in order, + before -: the first maximum wins ties
    by_type = hits.transpose(0, 2, 1, 3)
    total = by_type.sum(axis=3)
    flat = by_type.reshape(len(hits), -1, valid.shape[1])
    best, mosts = total.reshape(len(hits), -1).argmax(axis=1), total.max(axis=(1, 2))
    leaders, top = flat.argmax(axis=1), flat.max(axis=1)
    of_best = np.take_along_axis(flat, best[:, None, None], axis=1)[:, 0]
    other = (leaders != best[:, None]) & (top > 0) & (100 * top >= t.of_segment * valid) & (top >= t.clearly * of_best)
    near = 100 * total.max(axis=2) >= t.nearly * mosts[:, None]
    chimeric, many = other.any(axis=1).tolist(), (near.sum(axis=1) > 1).tolist()
    out = []
    for i, (n, most, length, (which, strand)) in enumerate(zip(counts.tolist(), mosts.tolist(), lengths, (divmod(b, 2) for b in best.tolist()), strict=True)):
        if not n or 100 * most < t.least * n:
            out.append((None, None, "unrecognizable", most, n, []))
        elif chimeric[i]:
            taxa = sorted({ctypes[which], *(ctypes[x // 2] for x in leaders[i][other[i]].tolist())})
            out.append((None, None, "chimeric", most, n, taxa))
        elif many[i]:
            out.append((None, None, "unresolvable", most, n, [ctypes[x] for x in np.flatnonzero(near[i]).tolist()]))
        else:
            status = "unusually long" if 100 * length > t.longest * longest[which] else "classified"
            out.append((ctypes[which], STRANDS[strand], status, most, n, [ctypes[which]]))
    return out


#: Bases, and cells of the counts, of the sequences that are looked up together.
MOST_BASES, MOST_CELLS = 1 << 18, 1 << 21


def together(seqs: list[str], cells: int) -> Iterator[list[str]]:
    """Sequences in order, so many at a time."""
    taken, bases = [], 0
    for s in seqs:
        if taken and (bases + len(s) > MOST_BASES or (len(taken) + 1) * cells > MOST_CELLS):
            yield taken
            taken, bases = [], 0
        taken.append(s)
        bases += len(s)
    if taken:
        yield taken


def _added(rows: list[tuple]) -> list[pa.Array]:
    columns = list(zip(*rows, strict=True)) or [[]] * len(ADDED)
    return [pa.array(c, kind) for c, kind in zip(columns, ADDED.values(), strict=True)]


def _by_search(rows: DataFrame, index: KmerIndex, t: Thresholds, seq_col: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for batch in batches:
            told = []
            for seqs in together([s or "" for s in batch.column(seq_col).to_pylist()], 2 * len(ix.ctypes) * t.segments):
                told += decide(*ix.hits(seqs, t.segments), [len(s) for s in seqs], ix.ctypes, ix.longest, t)
            yield pa.RecordBatch.from_arrays([*batch.columns, *_added(told)], [*batch.schema.names, *ADDED])

    return rows.mapInArrow(work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", " + ADDED_DDL)


def _by_join(rows: DataFrame, index: KmerIndex, t: Thresholds, seq_col: str) -> DataFrame:
    """K-mers become rows and are joined to the index's; a row's counts (by strand, type and segment) come back to it.
    Equal sequences are looked up once, so rows need no number of their own."""
    k, ctypes, longest = index.k, index.ctypes, index.longest
    seqs = rows.select(F.translate(F.upper(F.col(seq_col)), "U", "T").alias("s")).filter(F.length("s") >= k).distinct()
    at = seqs.select("s", (F.length("s") - k + 1).alias("n"), F.explode(F.sequence(F.lit(1), F.length("s") - k + 1)).alias("at"))
    word = F.substr("s", F.col("at"), F.lit(k))
    segment = F.expr(f"int((at - 1) * {t.segments} div n)")
    cut = at.select(F.sha2("s", 256).alias("name"), segment.alias("segment"), word.alias("word")).filter(F.col("word").rlike(f"^[ACGT]{{{k}}}$"))
    each = F.explode(F.array(F.struct(F.lit(0).alias("strand"), F.col("word").alias("w")), F.struct(F.lit(1).alias("strand"), reverse_complement(F.col("word")).alias("w"))))
    both = cut.select("name", "segment", each.alias("e")).select("name", "segment", "e.strand", F.conv(F.translate("e.w", "ACGT", "0123"), 4, 10).cast("long").alias("kmer"))
    found = both.join(index.table(rows.sparkSession), "kmer").groupBy("name", "strand", "ctype", "segment").agg(F.count("*").alias("n"))
    counts = found.groupBy("name").agg(F.collect_list(F.struct("strand", "ctype", "segment", "n")).alias("counts"))
    valid = cut.groupBy("name", "segment").agg(F.count("*").alias("n")).groupBy("name").agg(F.collect_list(F.struct("segment", "n")).alias("valid"))
    own = F.sha2(F.translate(F.upper(F.col(seq_col)), "U", "T"), 256)
    joined = rows.withColumn("name__", own).join(valid.join(counts, "name", "left").withColumnRenamed("name", "name__"), "name__", "left").drop("name__")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = []
            for s, own_valid, own_counts in zip(*(batch.column(c).to_pylist() for c in (seq_col, "valid", "counts")), strict=True):
                hits, n = np.zeros((2, len(ctypes), t.segments), np.int64), np.zeros(t.segments, np.int64)
                for v in own_valid or ():
                    n[v["segment"]] = v["n"]
                for c in own_counts or ():
                    hits[c["strand"], c["ctype"], c["segment"]] = c["n"]
                told += decide(hits[None], n[None], [len(s or "")], ctypes, longest, t)
            kept = [n for n in batch.schema.names if n not in ("valid", "counts")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *_added(told)], [*kept, *ADDED])

    return joined.mapInArrow(work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", " + ADDED_DDL)


def classifier(index: KmerIndex, thresholds: Thresholds | None = None, seq_col: str = "seq", most_bytes: int = MOST_BYTES) -> Callable[[DataFrame], DataFrame]:
    """Adds classified (a type, or null), strand, status, hits, kmers and taxa to rows with a sequence. A sequence that
    is null, shorter than k or of other letters only is unrecognizable."""
    t = thresholds or Thresholds()
    return lambda rows: (_by_search if index.nbytes() <= most_bytes else _by_join)(rows, index, t, seq_col)
