"""Byte-level BPE against the tokenizer library, exact round trips, odd rows."""

import base64
import hashlib
import random
import struct

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from latewatch.llm import bpe, queries

PATH = P.path(queries.RANK_FILE)
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OURS = bpe.ByteBpe(open(PATH, "rb").read(), P.PATTERN)


def same(text):
    ids = OURS.encode([text])[0]
    return np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text) and OURS.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80).filter(lambda t: not any(0xD800 <= ord(c) < 0xE000 for c in t)))
def test_any_text(text):
    assert same(text)


@pytest.mark.parametrize("text", [
    "", " ", "a", "\n\n  x", "<|endoftext|>", "I'm they'll 'RE", "a" * 511, "a" * 512, "a" * 5000, "ab" * 300, "é" * 400, "漢字" * 300, "x\x1c\x85 　y",
    "1234567890" * 60, "Donaudampfschifffahrtsgesellschaft" * 20, "\U0001f600" * 200, " " * 3000 + "x",
])
def test_odd_texts(text):
    assert same(text)


def test_pair_table():
    rng = np.random.default_rng(2)
    keys = np.unique((rng.integers(0, 300, 5000) << 32) | rng.integers(0, 300, 5000))
    table, known = bpe.PairTable(keys, np.arange(len(keys))), {int(k): i for i, k in enumerate(keys)}
    a, b = rng.integers(-1, 300, 20_000), rng.integers(-1, 300, 20_000)
    got = table.find(a, b)
    want = [known.get((int(x) << 32) | int(y), int(bpe._NONE)) if x >= 0 and y >= 0 else int(bpe._NONE) for x, y in zip(a, b)]
    assert got.tolist() == want


def test_cache_starts_afresh(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    rng = random.Random(1)
    for _ in range(20):
        assert same(" ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(40)))


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op9_bpe(spark, sf).collect():
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "", "y"), (2, "ab", "z")], "doc_id long, text string, ids string")
    out = bpe.round_trip(df, PATH, P.PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "bpe"]
    assert sorted((str(r.doc_id), r.bpe.n_tokens, bytes(r.bpe.decoded)) for r in out.collect()) == [("1", 0, b""), ("1", 0, b""), ("2", 1, b"ab"), ("None", 0, b"")]
    assert bpe.round_trip(df.limit(0), PATH, P.PATTERN).count() == 0
