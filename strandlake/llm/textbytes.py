"""Vectorised helpers over the UTF-8 bytes of Arrow string columns.

Everything here is a small per-batch helper that runs inside Spark tasks; nothing
keeps state between batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once; a longer single text is handled alone.
CHUNK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240917))
#: One random odd 64-bit value for each byte.
BYTE_VALUE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)
_MULT = np.uint64(0x9E3779B97F4A7C15)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that the order of hashes is unrelated to the texts."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold at most ``limit`` bytes together, or one text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_spans(raw: np.ndarray, offsets: np.ndarray, is_gap: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words of each text): maximal runs of bytes that aren't gaps; no run crosses texts."""
    word = ~is_gap[raw]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = offsets[1:-1][(offsets[1:-1] < len(raw)) & (offsets[1:-1] > 0)]
    first[inner] = word[inner]
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each span; spans are in order and don't overlap."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sizes = ends - starts
    total = int(sizes.sum())
    first = np.cumsum(sizes) - sizes
    within = np.arange(total) - np.repeat(first, sizes)
    at = within + np.repeat(starts, sizes)
    value = BYTE_VALUE[raw[at]]
    value *= powers(_MULT, int(sizes.max()))[within]
    return mix64(np.add.reduceat(value, first) + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


_SHINGLE = np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int = 5) -> Iterator[np.ndarray]:
    """For each text its sorted distinct hashes of ``words`` consecutive words (white space splits, A-Z are
    lower-cased). A text with fewer words gives the whole sequence as one; without words, an empty set."""
    for i, j in chunks(offsets):
        at = offsets[i : j + 1] - offsets[i]
        part = lower_ascii(raw[offsets[i] : offsets[j]])
        starts, ends, counts = word_spans(part, at)
        w = span_hashes(part, starts, ends)
        every = np.zeros(max(len(w) - words + 1, 0), np.uint64)
        for k in range(words):
            every *= _SHINGLE
            every += w[k : k + len(every)]
        every = mix64(every)
        first = np.cumsum(counts) - counts
        for f, c in zip(first.tolist(), counts.tolist(), strict=True):
            if c >= words:
                yield np.unique(every[f : f + c - words + 1])
            elif c:
                h = np.uint64(c)
                with np.errstate(over="ignore"):
                    for x in w[f : f + c]:
                        h = h * _SHINGLE + x
                yield mix64(np.array([h ^ np.uint64(0xA5A5A5A5)], np.uint64))
            else:
                yield np.empty(0, np.uint64)
