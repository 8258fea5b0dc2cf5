"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pre-token there is exactly one token that can end its encoding: the one that matches there
and is compatible with the last token of the prefix before it. Matches come from an automaton with suffix links
over the vocabulary, longest first; compatibility of two tokens is decided by undoing their merges. Back-pointers
then give the ids. Tokens are numbered in merge order, which the compatibility test relies on.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import prepare, sliced
from strandlake.llm.tokens import ChunkEncoder

#: Fixed value: the pre-tokenizer's pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable Latin-1 bytes stand for themselves,
    the others take the code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixEncoder:
    """Encodes pre-tokens and decodes ids with the vocabulary of a tokenizers JSON file."""

    PAIR_LIMIT = 500_000

    def __init__(self, tokenizer_path: str):
        import ahocorasick

        with open(tokenizer_path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        self.bytes_of: dict[int, bytes] = {}
        numbers = spec["model"]["vocab"]
        for text, number in numbers.items():
            self.bytes_of[number] = bytes(letters[c] for c in text)
        self.size = {k: len(v) for k, v in self.bytes_of.items()}
        self.halves = {k: (k, k) for k in self.bytes_of}
        self.merged: dict[int, int] = {}
        for pair in spec["model"]["merges"]:
            left, right = (numbers[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            whole = numbers[(pair.replace(" ", "") if isinstance(pair, str) else "".join(pair))]
            self.merged[left << 20 | right] = whole
            self.halves[whole] = (left, right)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.automaton = ahocorasick.Automaton()
        for number, raw in self.bytes_of.items():
            if number in self.size:
                self.automaton.add_word(raw.decode("latin-1"), number)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.pieces = regex.compile(PATTERN)

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoding of the two tokens' joint text is just these two: no merge across their border comes
        before the merges that made them."""
        limit = 1 << 40
        while True:
            if self.merged.get(a << 20 | b, limit) < limit:
                return False
            if a > b:
                limit, a = a, self.halves[a][1]
                if a == limit:
                    limit, b = b + 1, self.halves[b][0]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, self.halves[b][0]
                if b + 1 == limit:
                    limit, a = a, self.halves[a][1]
                    if a == limit:
                        return True

    def _fits(self, a: int, b: int) -> bool:
        if len(self.pairs) >= self.PAIR_LIMIT:
            self.pairs.clear()
        found = self.pairs[a << 20 | b] = self.compatible(a, b)
        return found

    def piece(self, raw: bytes) -> list[int]:
        """Ids of one pre-token."""
        last = [-1] * len(raw)
        size, known, fits = self.size, self.pairs.get, self._fits
        for end, token in self.automaton.iter(raw.decode("latin-1")):
            if last[end] < 0:
                before = end - size[token]
                if before < 0:
                    last[end] = token
                else:
                    a = last[before]
                    fit = known(a << 20 | token)
                    if fits(a, token) if fit is None else fit:
                        last[end] = token
        out, at = [], len(raw) - 1
        while at >= 0:
            out.append(last[at])
            at -= size[last[at]]
        return out[::-1]

    def chunk(self, text: str) -> bytes:
        return np.array([i for p in self.pieces.findall(text) for i in self.piece(p.encode())], "<u4").tobytes()

    def encoder(self) -> ChunkEncoder:
        (content, number), = self.special.items() or {None: 0}.items()
        return ChunkEncoder(self.chunk, content, number)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def loaded(tokenizer_path: str) -> tuple[PrefixEncoder, ChunkEncoder]:
    """One model for all tasks of a Python worker."""
    model = PrefixEncoder(tokenizer_path)
    return model, model.encoder()


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (little-endian unsigned 32-bit; null unless ``keep_ids``),
    ids_sha256, decoded_sha256 of the text decoded from the ids.

    A null or empty text has no ids. An added token's string in a text is that token. Repeated rows give repeated
    rows; no rows give none. Texts of any length are encoded whole, in time linear in their length.
    """
    prepare(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, encoder = loaded(tokenizer_path)
        for batch in sliced(batches):
            coded = encoder.encode(batch.column(1).to_pylist())
            back = [hashlib.sha256(model.decode(np.frombuffer(c, "<u4")).encode()).hexdigest() for c in coded]
            columns = [batch.column(0), pa.array([len(c) // 4 for c in coded], pa.int64()), pa.array(coded if keep_ids else [None] * len(coded), pa.binary()), pa.array([hashlib.sha256(c).hexdigest() for c in coded], pa.string()), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string")
