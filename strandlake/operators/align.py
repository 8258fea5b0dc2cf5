"""Local alignment with affine gaps, in Arrow batches.

A gap of k bases costs ``gap_open + (k - 1) * gap_extend``. The references of a group have one length, so their rows of
the score matrix are computed together, a vector operation over all of them at a time, and only the best one is
traced back.

Few cells matter when query and reference are alike: a path through diagonal d has at most min(n, m - d) matches (or
min(n + d, m) below the main one), so once some alignment has score L, no path that is as good leaves the diagonals
where that many matches reach L. Exact matches of 16 bases bound that further (``_Seeds``), so that long runs of N and
large indels don't open the band. A first sweep around the diagonals of those matches gives L; where the band that L
allows is wider, wider ones are swept, too. So the result is that of the whole matrix.

The directions of the band's cells are kept whole if they are few enough (always with ``one_pass``). Otherwise they are
kept for a block of rows at a time, and each block is computed again from the scores saved at its top while the path is
traced back, so memory stays small for long genomes that differ much.

Small matrices are computed many at a time, one vector operation over a row of all of them, and equal queries once.

Ties: the first best cell in row-major order; a match before an insertion before a deletion.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandlake.sources.config import Penalties

#: A matches nothing but itself; U counts as T; every code but ACGT scores 0 against all.
_CODE = np.full(256, 4, np.int8)
for _k, _letters in enumerate(("Aa", "Cc", "Gg", "TtUu")):
    for _c in _letters:
        _CODE[ord(_c)] = _k

_FAR = np.int32(-(1 << 29))


@dataclass(frozen=True)
class Alignment:
    score: int
    q_start: int
    q_end: int
    r_start: int
    r_end: int
    cigar: str


#: Cells whose directions are kept at once, and up to which all are computed in one sweep.
MOST_CELLS, FEW_CELLS = 1 << 26, 1 << 20


def _profiles(references: list[str], p: Penalties) -> np.ndarray:
    """The score of each code against each base of each reference."""
    codes = np.stack([_CODE[np.frombuffer(r.encode(), np.uint8)] for r in references])
    table = np.full((5, 5), -p.mismatch, np.int32)
    np.fill_diagonal(table, p.match)
    table[4, :] = table[:, 4] = 0
    return table[:, codes]


@dataclass
class _Rows:
    """The row of the matrix above the next one, for all references: scores, and scores that end in an insertion."""

    h: np.ndarray
    e: np.ndarray

    @classmethod
    def top(cls, count: int, m: int) -> _Rows:
        return cls(np.zeros((count, m), np.int32), np.full((count, m), _FAR, np.int32))

    def copy(self) -> _Rows:
        return _Rows(self.h.copy(), self.e.copy())


@dataclass
class _Kept:
    """The rows above each block of query bases within a band."""

    block: int
    band: tuple[int, int]
    rows: list[_Rows]

    @classmethod
    def of(cls, n: int, band: tuple[int, int], most_cells: int) -> _Kept:
        width = band[1] - band[0] + 1
        return cls(n if n * width <= most_cells else max(1, min(math.isqrt(n), most_cells // width)), band, [])


def _sweep(query: np.ndarray, profile: np.ndarray, p: Penalties, rows: _Rows, band: tuple[int, int], first: int = 0, trace: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray]]:
    """Computes the rows of some query bases, the first of which has number ``first``, within diagonals ``band`` (both
    included). Yields each row's number, first column and scores; ``rows`` then hold it. Cells outside count as
    empty alignments. ``trace`` gets directions, its column 0 being that of the lowest diagonal."""
    m = profile.shape[2]
    h, e = rows.h, rows.e
    ramp = np.arange(m, dtype=np.int32) * np.int32(p.gap_extend)
    opening = ramp + np.int32(p.gap_open)
    for i, c in enumerate(query.tolist(), first):
        lo, hi = max(0, i + band[0]), min(m, i + band[1] + 1)
        if lo >= hi:
            continue
        opened, longer = h[:, lo:hi] - np.int32(p.gap_open), e[:, lo:hi] - np.int32(p.gap_extend)
        inserted = np.maximum(opened, longer)
        diagonal = profile[c, :, lo:hi].copy()
        if lo:
            diagonal += h[:, lo - 1 : hi - 1]
        else:
            diagonal[:, 1:] += h[:, : hi - 1]
        best = np.maximum(diagonal, inserted)
        np.maximum(best, 0, out=best)
        reach = best + ramp[: hi - lo]
        np.maximum.accumulate(reach, axis=1, out=reach)
        deleted = reach[:, :-1] - opening[: hi - lo - 1]
        new = best.copy()
        np.maximum(best[:, 1:], deleted, out=new[:, 1:])
        if trace is not None:
            source = np.where(new == diagonal, 1, np.where(new == inserted, 2, 3)).astype(np.uint8)
            source[new <= 0] = 0
            source |= (longer >= opened).astype(np.uint8) << 2
            source[:, 2:] |= (deleted[:, :-1] - np.int32(p.gap_extend) >= best[:, 1:-1] - np.int32(p.gap_open)).astype(np.uint8) << 3
            at = lo - i - band[0]
            trace[i - first, :, at : at + hi - lo] = source
        h[:, lo:hi], e[:, lo:hi] = new, inserted
        yield i, lo, new


def _best(query: np.ndarray, profile: np.ndarray, p: Penalties, band: tuple[int, int], trace: np.ndarray | None = None, kept: _Kept | None = None) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The best score of each reference within the band, and its first cell in row-major order. The rows above each
    block are kept, if there are any."""
    count, m = profile.shape[1:]
    best, at = np.zeros(count, np.int32), [(-1, -1)] * count
    rows, block = _Rows.top(count, m), kept.block if kept else max(1, len(query))
    for first in range(0, len(query), block):
        if kept:
            kept.rows.append(rows.copy())
        for i, lo, new in _sweep(query[first : first + block], profile, p, rows, band, first, trace):
            top = new.max(axis=1)
            if (top > best).any():
                for r in np.flatnonzero(top > best).tolist():
                    best[r], at[r] = top[r], (i, lo + int(new[r].argmax()))
    return best, at


def _allowed(score: int, n: int, m: int, p: Penalties) -> tuple[int, int]:
    """The diagonals that a path of at least this score can touch."""
    matches = -(-score // p.match) if p.match > 0 else 0
    return max(matches - n, 1 - n), min(m - matches, m - 1)


#: Bases of an exact match, the width of a bin of their diagonals, and the least share of all that a bin needs.
SEED, BIN, LEAST_SHARE = 16, 64, 0.01


def _stretches(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the stretches of SEED bases without N, and where they start."""
    if len(codes) < SEED:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    numbers = np.zeros(len(codes) - SEED + 1, np.int64)
    for k in range(SEED):
        numbers = numbers * 4 + (codes[k : k + len(numbers)] & 3)
    unsure = np.concatenate(([0], np.cumsum(codes > 3)))
    at = np.flatnonzero(unsure[SEED:] == unsure[:-SEED])
    return numbers[at], at


def _runs(unsure: np.ndarray) -> int:
    """Maximal runs of true values."""
    return int(unsure[0]) + int((unsure[1:] & ~unsure[:-1]).sum())


@dataclass
class _Seeds:
    """Exact matches of SEED bases between a query and references of one length.

    ``core`` are the diagonals between those that many matches lie on; ``outside`` counts query positions with a match
    elsewhere, ``runs`` the runs of N. From them follows how far from the core a path with some score can get:

    * A path that keeps off the core has at most ``outside`` matches of SEED bases. Of M single matches in r runs at
      least M - (SEED - 1) r are starts of such, and every break between two runs is a run of N, or costs a gap or a
      mismatch (and the match that it isn't). The more breaks, the more it costs; the fewer, the fewer matches.
    * A path that touches the core pays for the gaps between it and the diagonals that it reaches.
    """

    core: tuple[int, int]
    outside: int
    anywhere: int  # query positions with a match on any diagonal
    runs: int
    most: int  # single matches, at most

    @classmethod
    def of(cls, query: np.ndarray, references: np.ndarray) -> _Seeds:
        n, m = len(query), references.shape[1]
        asked, q_at = _stretches(query)
        ends, single = [], []  # least and largest diagonal of each position that has a match
        for reference in references:
            numbers, at = _stretches(reference)
            order = np.argsort(numbers, kind="stable")
            numbers, at = numbers[order], at[order]
            left, right = np.searchsorted(numbers, asked), np.searchsorted(numbers, asked, side="right")
            hit = np.flatnonzero(right > left)
            ends.append((hit, at[left[hit]] - q_at[hit], at[right[hit] - 1] - q_at[hit]))
            single.append(ends[-1][1][ends[-1][1] == ends[-1][2]])
        most = min(int((query < 4).sum()), int((references < 4).sum(axis=1).max()))
        runs = _runs(query > 3) + max(_runs(r > 3) for r in references)
        diagonals = np.concatenate(single)
        core = (min(0, m - n), max(0, m - n))
        if len(diagonals):
            bins, counts = np.unique(diagonals // BIN, return_counts=True)
            strong = bins[counts >= max(2, LEAST_SHARE * len(diagonals))]
            if not len(strong) or 4 * (strong[-1] - strong[0]) * BIN > n + m:
                strong = bins[counts.argmax()][None]
            found = diagonals[(diagonals // BIN >= strong[0]) & (diagonals // BIN <= strong[-1])]
            core = int(found.min()), int(found.max())
        anywhere, elsewhere = np.zeros(len(asked), bool), np.zeros(len(asked), bool)
        for hit, least, largest in ends:
            anywhere[hit] = True
            elsewhere[hit[(least < core[0]) | (largest > core[1])]] = True
        return cls(core, int(elsewhere.sum()), int(anywhere.sum()), runs, most)

    def _limit(self, starts: int, each: int, p: Penalties) -> float:
        """No path with so many matches of SEED bases has a better score."""
        unbroken = p.match * (starts + (SEED - 1) * (self.runs + 1))
        breaks = max(0.0, (p.match * self.most - unbroken) / (each + p.match * (SEED - 1)))
        return p.match * self.most - each * breaks

    def narrowed(self, band: tuple[int, int], score: int, p: Penalties) -> tuple[int, int]:
        """The diagonals of a band that a path of at least this score can touch."""
        each, step = min(p.match + p.mismatch, p.gap_open), min(p.gap_open, p.gap_extend)
        if p.match <= 0 or each <= 0 or step <= 0 or self._limit(self.outside, each, p) >= score:
            return band
        whole = math.floor(self._limit(self.anywhere, each, p))
        far = max(0, (whole - score - max(0, p.gap_open - p.gap_extend)) // step)
        return max(band[0], self.core[0] - far), min(band[1], self.core[1] + far)


def _path(query: np.ndarray, profile: np.ndarray, p: Penalties, band: tuple[int, int], at: tuple[int, int], whole: bool, most_cells: int, known: np.ndarray | None = None, kept: _Kept | None = None) -> tuple[int, int, str]:
    """Start of the alignment that ends in a cell of one reference, and its operations in reverse. ``known`` has the
    directions of all rows, ``kept`` the rows above blocks, if they are known."""
    i, j = at
    m, n = profile.shape[2], at[0] + 1
    if known is None and kept is None:
        kept = _Kept(n, band, [_Rows.top(1, m)]) if whole else _Kept.of(n, band, most_cells)
        rows = _Rows.top(1, m)
        for first in range(0, n, kept.block):
            if len(kept.rows) * kept.block <= first:
                kept.rows.append(rows.copy())
            if first + kept.block < n:
                for _ in _sweep(query[first : first + kept.block], profile, p, rows, band, first):
                    pass
    block = kept.block if kept else n
    width = band[1] - band[0] + 1
    first, trace = (-1, np.empty((0, 0), np.uint8)) if known is None else (0, known)
    ops: list[str] = []
    state = "M"
    while i >= 0 and j >= 0:
        if first != i // block * block:
            first = i // block * block
            made = np.zeros((min(block, at[0] + 1 - first), 1, width), np.uint8)
            for _ in _sweep(query[first : first + len(made)], profile, p, kept.rows[i // block].copy(), band, first, made):
                pass
            trace = made[:, 0]
        cell = trace[i - first, j - i - band[0]] if band[0] <= j - i <= band[1] else 0
        if state == "M":
            source = cell & 3
            if not source:
                break
            if source == 1:
                ops.append("M")
                i, j = i - 1, j - 1
            else:
                state = "I" if source == 2 else "D"
        elif state == "I":
            ops.append("I")
            if not cell & 4:
                state = "M"
            i -= 1
        else:
            ops.append("D")
            if not cell & 8:
                state = "M"
            j -= 1
    return i + 1, j + 1, "".join(ops)


#: Cells of a row of small matrices, and of all their rows, that are computed together.
ROW_CELLS, BATCH_CELLS = 1 << 15, 1 << 24


def _walked(cells: bytes, m: int, i: int, j: int) -> tuple[int, int, str]:
    """Start and operations in reverse of the path that ends in a cell, from the directions of a whole matrix."""
    ops: list[str] = []
    at = i * m + j
    while i >= 0 and j >= 0:
        source = cells[at] & 3
        if source == 1:
            ops.append("M")
            i, j, at = i - 1, j - 1, at - m - 1
        elif source == 2:
            longer = True
            while longer and i >= 0:
                longer = cells[at] & 4
                ops.append("I")
                i, at = i - 1, at - m
        elif source == 3:
            longer = True
            while longer and j >= 0:
                longer = cells[at] & 8
                ops.append("D")
                j, at = j - 1, at - 1
        else:
            break
    return i + 1, j + 1, "".join(ops)


def _small_alignments(queries: list[np.ndarray], profile: np.ndarray, p: Penalties) -> list[tuple[int, Alignment] | None]:
    """The best alignments of queries of about one length, whose whole matrices are computed together."""
    lengths = np.array([len(q) for q in queries])
    count, n, (refs, m) = len(queries), int(lengths.max()), profile.shape[1:]
    codes = np.full((count, n), 4, np.int8)
    for k, q in enumerate(queries):
        codes[k, : len(q)] = q
    h, e = np.zeros((count, refs, m), np.int32), np.full((count, refs, m), _FAR, np.int32)
    ramp = np.arange(m, dtype=np.int32) * np.int32(p.gap_extend)
    opening = ramp[: m - 1] + np.int32(p.gap_open)
    matched, put_in, left_out = np.uint8(1), np.uint8(2), np.uint8(3)
    trace = np.zeros((n, count, refs, m), np.uint8)
    best, at_i, at_j = (np.zeros((count, refs), np.int32) for _ in range(3))
    for i in range(n):
        opened, longer = h - np.int32(p.gap_open), e - np.int32(p.gap_extend)
        e = np.maximum(opened, longer)
        diagonal = np.take(profile, codes[:, i], axis=0)
        diagonal[..., 1:] += h[..., :-1]
        h = np.maximum(diagonal, e)
        np.maximum(h, 0, out=h)
        started = h[..., 1:-1] - np.int32(p.gap_open)
        reach = h + ramp
        np.maximum.accumulate(reach, axis=-1, out=reach)
        deleted = reach[..., :-1] - opening
        np.maximum(h[..., 1:], deleted, out=h[..., 1:])
        source = trace[i]
        source[...] = np.where(h == diagonal, matched, np.where(h == e, put_in, left_out))
        source *= h > 0
        source |= (longer >= opened).view(np.uint8) << np.uint8(2)
        source[..., 2:] |= (deleted[..., :-1] - np.int32(p.gap_extend) >= started).view(np.uint8) << np.uint8(3)
        top = h.max(axis=-1)
        better = np.nonzero((top > best) & (i < lengths)[:, None])
        best[better], at_i[better], at_j[better] = top[better], i, h[better].argmax(axis=-1)
    out: list[tuple[int, Alignment] | None] = []
    for k, which in enumerate(best.argmax(axis=1).tolist()):
        score, last_i, last_j = (int(x[k, which]) for x in (best, at_i, at_j))
        if not score:
            out.append(None)
            continue
        i, j, ops = _walked(trace[: last_i + 1, k, which].tobytes(), m, last_i, last_j)
        out.append((which, Alignment(score, i, last_i + 1, j, last_j + 1, _cigar(ops))))
    return out


def _cigar(ops: str) -> str:
    return "".join(f"{len(list(run))}{op}" for op, run in groupby(reversed(ops)))


def best_alignments(queries: list[str], references: list[str], p: Penalties, one_pass: bool, few_cells: int = FEW_CELLS) -> list[tuple[int, Alignment] | None]:
    """``best_alignment`` of each query."""
    m, count = len(references[0]) if references else 0, len(references)
    out: list[tuple[int, Alignment] | None] = [None] * len(queries)
    small = [k for k, q in enumerate(queries) if q and m and count * len(q) * (len(q) + m) <= few_cells]
    for k in sorted(set(range(len(queries))) - set(small)):
        out[k] = best_alignment(queries[k], references, p, one_pass, few_cells=few_cells)
    small.sort(key=lambda k: len(queries[k]), reverse=True)
    profile = _profiles(references, p) if small else None
    while small:
        together = max(1, min(ROW_CELLS // (count * m), BATCH_CELLS // (count * m * len(queries[small[0]]))))
        taken, small = small[:together], small[together:]
        made = _small_alignments([_CODE[np.frombuffer(queries[k].encode(), np.uint8)] for k in taken], profile, p)
        for k, found in zip(taken, made, strict=True):
            out[k] = found
    return out


def best_alignment(query: str, references: list[str], p: Penalties, one_pass: bool, most_cells: int = MOST_CELLS, few_cells: int = FEW_CELLS) -> tuple[int, Alignment] | None:
    """The best local alignment with a group of references of one length; the first wins ties. None without a positive
    score."""
    q = _CODE[np.frombuffer(query.encode(), np.uint8)]
    n, m = len(q), len(references[0]) if references else 0
    if not n or not m:
        return None
    profile = _profiles(references, p)
    near, band = max(32, n // 400), (0, -1)
    wanted = every = (1 - n, m - 1)
    trace, seeds, kept = None, None, None

    def allowed(score: int) -> tuple[int, int]:
        found = _allowed(score, n, m, p)
        return seeds.narrowed(found, score, p) if seeds is not None else found

    if len(references) * n * (n + m) <= few_cells:  # vectors are short, so rows cost more than cells
        band, trace = every, np.zeros((n, len(references), n + m - 1), np.uint8)
        best, at = _best(q, profile, p, band, trace)
    else:
        seeds = _Seeds.of(q, np.stack([_CODE[np.frombuffer(r.encode(), np.uint8)] for r in references]))
    while wanted[0] < band[0] or wanted[1] > band[1]:
        swept = band[1] - band[0] + 1
        band = max(every[0], seeds.core[0] - near), min(every[1], seeds.core[1] + near)
        if swept and wanted[1] - wanted[0] < 8 * swept:
            band = wanted
        elif 2 * (band[1] - band[0]) > n + m:
            band = every
        kept = _Kept.of(n, band, most_cells) if len(references) == 1 and not one_pass else None
        best, at = _best(q, profile, p, band, None, kept)
        wanted = allowed(int(best.max()))
        near *= 8
    which = int(best.argmax())
    score = int(best[which])
    if not score:
        return None
    of_path = every if trace is not None else kept.band if kept else allowed(score)
    i, j, ops = _path(q, profile[:, which : which + 1], p, of_path, at[which], one_pass, most_cells, None if trace is None else trace[:, which], kept)
    return which, Alignment(score, i, at[which][0] + 1, j, at[which][1] + 1, _cigar(ops))


def align(query: str, reference: str, p: Penalties, one_pass: bool = True, most_cells: int = MOST_CELLS, few_cells: int = FEW_CELLS) -> Alignment | None:
    """The best local alignment; None without a positive score."""
    found = best_alignment(query, [reference], p, one_pass, most_cells, few_cells)
    return found and found[1]


ALIGNED = "ref_index int, score int, q_start int, q_end int, r_start int, r_end int, cigar string"

#: (reference_id, ctype) to the sequences, penalties and whether directions are kept whole.
Groups = dict[tuple[str, str], tuple[list[str], Penalties, bool]]
#: Bases of all references together that may be sent to the executors.
MOST_BASES = 1 << 28
#: Bases of the queries whose alignments a task remembers, as equal ones are frequent.
KNOWN_BASES = 1 << 23


def align_rows(rows: DataFrame, groups: Groups) -> DataFrame:
    """Adds ALIGNED to rows of (query_id, ctype, reference_id, nt, chewed); null where nothing aligns. Chewed bases are
    left out of the alignment but counted in its query coordinates."""
    if sum(len(s) for seqs, *_ in groups.values() for s in seqs) > MOST_BASES:
        raise ValueError("the references of a module are too large to be sent to the executors")
    shared = rows.sparkSession.sparkContext.broadcast(groups)
    fields = [x.split() for x in ALIGNED.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], dict[str, tuple | None]] = {}
        bases = 0
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("reference_id", "ctype", "nt", "chewed")}
            rows_of = [(r, c, nt[chewed:], chewed) for r, c, nt, chewed in zip(*columns.values(), strict=True)]
            if bases > KNOWN_BASES:
                known, bases = {}, 0
            asked: dict[tuple[str, str], dict[str, None]] = {}
            for r, c, nt, _ in rows_of:
                if nt not in known.setdefault((r, c), {}):
                    asked.setdefault((r, c), {})[nt] = None
            for key, some in asked.items():
                for nt, found in zip(some, best_alignments(list(some), *shared.value[key]), strict=True):
                    known[key][nt] = found and (found[0], found[1].score, found[1].q_start, found[1].q_end, found[1].r_start, found[1].r_end, found[1].cigar)
                    bases += len(nt)
            out = []
            for r, c, nt, chewed in rows_of:
                a = known[r, c][nt]
                out.append((None,) * 7 if a is None else (a[0], a[1], a[2] + chewed, a[3] + chewed, *a[4:]))
            made = [pa.array(c, pa.string() if f[1] == "string" else pa.int32()) for c, f in zip(zip(*out, strict=True) if out else [[]] * 7, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *(f[0] for f in fields)])

    return rows.mapInArrow(work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", " + ALIGNED)
