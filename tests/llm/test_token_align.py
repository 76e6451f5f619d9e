"""Token alignment against a plain version, over texts of all kinds and whole tables."""

import hashlib
import json
import unicodedata
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from latewatch.llm import queries, token_align

A_PATH, B_PATH = (P.path(x) for x in queries.ALIGNED)
A, B = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
A.encode_special_tokens = True
OURS = token_align.Aligner(open(A_PATH, encoding="utf-8").read(), open(B_PATH, "rb").read())
UNITS = {}
for b in range(256):  # a byte is shown as itself if it is printable, else as the next free character from 256 on
    shown = 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b
    UNITS[chr(b) if shown else chr(256 + sum(v < b and not (33 <= v <= 126 or 161 <= v <= 172 or 174 <= v) for v in range(256)))] = b


def tokens(text):
    a = A.encode(" " + text, add_special_tokens=False)
    b = B.encode(text)
    pieces = [B.id_to_piece(i) for i in b]
    return (
        [(i, bytes(UNITS[c] for c in t)) for i, t in zip(a.ids, a.tokens)],
        [(i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()) for i, p in zip(b, pieces)],
    )


def plain(text):
    """n_a, n_b, groups and links by comparing every end with every other."""
    if not text:
        return 0, 0, [], []
    a, b = tokens(text)
    want = (" " + text).encode()
    if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
        return 0, 0, [], []
    ends = []
    for side in (a, b):
        at, out = 0, {}
        for k, (_, x) in enumerate(side):
            at += len(x)
            out[at] = k
        ends.append(out)
    shared = sorted(ends[0].keys() & ends[1].keys())
    links = [(a[ends[0][e]][0], b[ends[1][e]][0]) for e in shared]
    found, i, j = [], 0, 0
    for e in shared:
        i1, j1 = ends[0][e] + 1, ends[1][e] + 1
        found.append(",".join(str(x) for x, _ in a[i:i1]) + "|" + ",".join(str(x) for x, _ in b[j:j1]))
        i, j = i1, j1
    return len(a), len(b), found, links


def digests(docs):
    done = [(d, plain(t)) for d, t in docs]
    count = Counter(link for _, (_, _, _, links) in done for link in links)
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return sorted((
        (d, n_a, n_b, len(g), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
         hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for d, (n_a, n_b, g, links) in done), key=repr)


def check(text):
    n_a, n_b, found, links = plain(text)
    got = OURS.many([text])[0]
    assert got[:4] == (n_a, n_b, len(found), ";".join(found))
    assert Counter({p: n for p, n in zip(got[4].tolist(), got[5].tolist())}) == Counter(a * 2**32 + b for a, b in links)


ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a\n\nb", "\n", "\t x", "▁x", "x▁ y", "é", "é", "ﬁ", "\x00a", "<s>hi</s>", "<unk>", "<0x41>", "<|endoftext|>",
    "a <|endoftext|> b", "a\tb\r\nc", "　x", "漢字かな交じり文" * 30, "\U0001f600" * 50, "‍​", "word" * 300, "Donaudampfschiff " * 100, "1234567890" * 40,
    " " * 500 + "x", "a b", "﻿x",
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    check(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n▁aeé漢<0x>"), st.characters(codec="utf-8")), max_size=60))
def test_any_text(text):
    check(text)


def test_byte_level_is_complete():
    level = token_align.byte_level()
    assert level == UNITS and sorted(level.values()) == list(range(256))


def test_ranks_of_the_file_give_its_ids(monkeypatch):
    """The faster encoder is used for the file, and gives the ids of the library of its format: on texts, and on every letter, number, mark and space there is."""
    raw = open(A_PATH, encoding="utf-8").read()
    calls = []
    monkeypatch.setattr(token_align, "_listed", lambda j: calls.append(j))
    token_align.Aligner(raw, open(B_PATH, "rb").read())
    assert not calls
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    texts = [" " + "".join(f"a{c}{c}1{c} {c}'s{c}\n" for c in every[k : k + 200]) for k in range(0, len(every), 200)]
    texts += [" " + t for t in ODD] + [" don't WE'LL  it's  \t\n x", " 12ab34", " ...a"]
    want = [x.ids for x in A.encode_batch_fast(texts, add_special_tokens=False)]
    wrong = [t for t, x, y in zip(texts, OURS.encode_a(texts), want, strict=True) if x != y]
    assert wrong == []


def test_other_files_are_read_by_their_library():
    raw = json.loads(open(A_PATH, encoding="utf-8").read())
    raw["model"]["merges"] = [raw["model"]["merges"][1], raw["model"]["merges"][0], *raw["model"]["merges"][2:]]
    other = token_align.Aligner(json.dumps(raw), open(B_PATH, "rb").read())
    assert other.encode_a([" the cat"]) == [Tokenizer.from_str(json.dumps(raw)).encode(" the cat").ids]


def test_store_starts_afresh(monkeypatch):
    monkeypatch.setattr(token_align, "STORE", 3)
    monkeypatch.setattr(token_align, "BLOCK", 2)
    for text in ODD * 2:
        check(text)


def test_batches_are_the_texts_one_by_one():
    for k in range(len(ODD)):
        batch = ODD[k:] + ODD[:k]
        got = OURS.many(batch)
        for text, x in zip(batch, got, strict=True):
            alone = OURS.many([text])[0]
            assert x[:4] == alone[:4] and x[4].tolist() == alone[4].tolist() and x[5].tolist() == alone[5].tolist()


def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.op13_token_align(spark, sf)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == digests(docs)


@pytest.mark.parametrize("limit", [32 * 1024 * 1024, 0])
def test_odd_rows(spark, monkeypatch, limit):
    """Nulls, repeats, a very long text, clashing names; with the counts broadcast and shuffled."""
    monkeypatch.setattr(token_align, "fits", lambda df: token_align_fits(df, limit))
    rows = [(i, t) for i, t in enumerate(ODD)] + [(1, "a"), (1, "a"), (None, "a b"), (None, None), (99, None), (98, "the cat sat, " * 30_000)]
    df = spark.createDataFrame([(*r, "p", 1, "g") for r in rows], "doc_id long, text string, pair string, count long, groups string").repartition(3)
    out = token_align.compare(df, A_PATH, B_PATH)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == digests(rows)
    assert token_align.compare(df.limit(0), A_PATH, B_PATH).collect() == []


token_align_fits = token_align.fits
