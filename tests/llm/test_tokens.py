import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

public_tokenizers = pytest.importorskip("public_tokenizers")

from strandlake.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
MODEL = bpe.PrefixEncoder(PATH)
ENCODER = MODEL.encoder()
CACHED = packing.Encoder(PATH)

ODD = ["", " ", "  a  ", "a \n b", "don't  stop\n\n  x", "é" * 40, "a" * 3000, "<|endoftext|>", "x  <|endoftext|>  y<|endoftext|>", "\x00\x1c\x85\xa0​  　z", "12 345,67 ½", "🙂🙂 🙂", "\r\n\t tab", " lead", "trail "]


def expected(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_ids_equal_the_library(text):
    for encoder in (ENCODER, CACHED):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == expected(text)
    assert MODEL.decode(np.array(expected(text), "<u4")) == LIBRARY.decode(expected(text), skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'ab1.,Té\x1c\x85 <|>"), st.characters(codec="utf-8")), max_size=60))
def test_ids_equal_the_library_on_any_text(text):
    for encoder in (ENCODER, CACHED):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == expected(text)


def test_pieces_are_the_binary_digits():
    for n in (1, 2, 3, 2047, 2048, 2049, 10_000):
        p = packing.pieces_of(n, 2048)
        assert sum(p) == n and all(x & (x - 1) == 0 for x in p)
        assert p == sorted(p, reverse=True)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, length int")


ROWS = [(1, "hello world " * 900, "x", 1), (2, None, "x", 1), (3, "", None, None), (None, "a b c", None, 2), (5, "same", "", 1), (5, "same", "", 1)]


def test_pack(spark):
    got = packing.pack(documents(spark, ROWS), PATH, 64).collect()
    assert len({r.sequence_id for r in got}) == len(got)
    for doc_id, text, *_ in ROWS:
        ids = [*expected(text or ""), 1]
        own = sorted({(r.start, r.length, bytes(r.ids)) for r in got if r.doc_id == doc_id})
        assert np.frombuffer(b"".join(x[2] for x in own), "<u4").tolist() == ids
        assert all(len(x[2]) == 4 * x[1] for x in own)
    assert all(r.offset == 0 and r.length == 1 << r.bucket for r in got)
    assert sum(r.length for r in got if r.doc_id == 5) == 2 * (len(expected("same")) + 1)
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_encode(spark):
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode(documents(spark, ROWS), PATH).collect()}
    want = set()
    for doc_id, text, *_ in ROWS:
        ids = expected(text or "")
        want.add((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == want
    assert bpe.encode(documents(spark, []), PATH).count() == 0
