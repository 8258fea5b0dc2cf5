"""Whole-text encoding through a dictionary of white-space chunks.

A byte-level pre-tokenizer never joins a blank that stands before a non-blank to what is left of it, so a text
may be cut there and its chunks encoded one by one. Repeated chunks are looked up.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?:\s|\Z)")


def cut(text: str) -> list[str]:
    """The first chunk, then the others without their leading blank."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


class Known(dict):
    """Ids of chunks that follow a blank. It holds at most ``limit`` of them and starts anew beyond it."""

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        found = self[chunk] = self.make(" " + chunk)
        return found


class ChunkEncoder:
    """make turns a chunk into its ids as little-endian unsigned 32-bit bytes; the special string is one id."""

    def __init__(self, make: Callable[[str], bytes], special: str | None = None, special_id: int = 0, limit: int = 600_000):
        self.make, self.special = make, special
        self.special_bytes = np.uint32(special_id).tobytes()
        self.known = Known(make, limit)

    def section(self, text: str) -> bytes:
        parts = cut(text)
        return self.make(parts[0]) + b"".join(map(self.known.__getitem__, parts[1:]))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as bytes; None counts as empty."""
        return [self.special_bytes.join(map(self.section, t.split(self.special) if self.special else [t])) for t in (x or "" for x in texts)]
