"""Packing by power-of-two decomposition.

Every document's ids, with an end id, are cut into pieces whose lengths are powers of two (the binary digits of
the length; whole ``max_len`` pieces first). A piece is a sequence of its own, so no sequence crosses documents
and none is padded; sequences of equal length share a bucket, from which batches of one shape are drawn.

One narrow stage, no shuffle: the work of a task is its own documents, whatever their source or length.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.bpe import PATTERN, byte_letters
from strandlake.llm.runtime import prepare, sliced

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, bucket int"


def pieces_of(n: int, max_len: int) -> list[int]:
    """n as whole ``max_len`` pieces, then the binary digits of the rest, largest first."""
    out = [max_len] * (n // max_len)
    rest = n % max_len
    return out + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


class Encoder:
    """Ids of the byte-level vocabulary of a tokenizers JSON file. The ranks of that vocabulary are given to the
    tiktoken library, whose ids are the same and come faster; a text that it can't take goes to tokenizers."""

    def __init__(self, tokenizer_path: str):
        import tiktoken

        with open(tokenizer_path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in text): number for text, number in spec["model"]["vocab"].items()}
        self.path, self.slow = tokenizer_path, None
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        (self.special, number), = {t["content"]: t["id"] for t in spec["added_tokens"]}.items()
        self.special_bytes = np.uint32(number).tobytes()

    def section(self, text: str) -> bytes:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        except BaseException as problem:  # the library's panic isn't an Exception
            if type(problem).__name__ != "PanicException" and not isinstance(problem, ValueError):
                raise
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [self.special_bytes.join(map(self.section, (t or "").split(self.special))) for t in texts]


@lru_cache(maxsize=1)
def loaded(tokenizer_path: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(tokenizer_path)


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, bucket (log2 of
    the length), sequence_id, offset.

    ``max_len`` must be a power of two. A null or empty text is the end id alone. Repeated rows are packed once
    each. No rows give no pieces. sequence_id holds the bucket in its upper bits and a number that is unique in
    this run below.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    prepare(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(tokenizer_path)
        end = np.uint32(end_id).tobytes()
        for batch in sliced(batches):
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                ids += end
                start, n = 0, len(ids) // 4
                for size in pieces_of(n, max_len):
                    rows.append((doc_id, start, size, ids[4 * start : 4 * (start + size)], n, size.bit_length() - 1))
                    start += size
            if rows:
                columns = zip(*rows, strict=True)
                types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "start", "length", "ids", "doc_tokens", "bucket"])

    made = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, PIECES)
    number: Column = F.shiftleft(F.col("bucket").cast("long"), 59).bitwiseOR(F.monotonically_increasing_id())
    return made.withColumns({"sequence_id": number, "offset": F.lit(0).cast("long")})


def digest(packed: DataFrame) -> DataFrame:
    """The ids of each piece as their CRC-32."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
