"""Language model: counts by brute force, normalised probabilities, gain on held-out texts, odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from latewatch.llm import lm

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)) + ["\n"]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def check(rows, out):
    counts = Counter(w for i, t in rows if not held(i) for w in plain_tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        w = plain_tokens(t)
        base = sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w)
        want[i, held(i), len(w), sum(counts[x] > 0 for x in w), total, round(base, 5)] += 1
    assert want == Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out)
    assert all(r.score <= 1e-9 and math.isfinite(r.score) for r in out)


def test_counts_and_gain(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = lm.score(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    check(rows, out)
    gain = lambda h: sum(r.score - r.base_score for r in out if r.held_out == h)
    assert gain(True) > 0 and gain(False) > 0


def test_rare_words_are_joined(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 3)
    rows = [(k, " ".join(f"w{j % (k + 2)}" for j in range(30)) + f" Own{k}é") for k in range(40)]
    check(rows, lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (3, " \n\t"), (None, "A b"), (5, "x\u0085y  z"), (2, "A"), (7, "long " * 50_000)]
    df = spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "doc_id long, text string, token string, score double")
    check(rows, lm.score(df).collect())
    assert lm.score(df.limit(0)).count() == 0
    only_held_out = [(k, "a b") for k in range(60) if held(k)]
    check(only_held_out, lm.score(spark.createDataFrame(only_held_out, "doc_id long, text string")).collect())


def test_table_is_normalised_and_learns():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 20, 40_000)
    b = np.where(rng.random(40_000) < 0.9, (a + 1) % 20, rng.integers(0, 20, 40_000))
    pairs, counts = np.unique(a * lm.CLASSES + b, return_counts=True)
    table = lm.train(pairs, counts)
    assert np.allclose((10.0 ** table.astype(float)).sum(axis=1), 1, atol=1e-3)
    assert all(10 ** table[k, (k + 1) % 20] > 0.6 for k in range(20))


def test_hash_and_bucket_agree_with_spark(spark):
    words = ["a", "ab", "abc", "abcd", "étés", "\U0001f600x", "漢字漢字", "x" * 100]
    df = spark.createDataFrame([(w,) for w in words], "token string")
    got = df.select("token", F.xxhash64("token").alias("h"), F.pmod(F.crc32(F.expr("right(token, 3)").cast("binary")), F.lit(lm.BUCKETS)).alias("b")).collect()
    for r in got:
        assert r.h == lm._signed(xxhash.xxh64_intdigest(r.token.encode(), 42)) and r.b == lm.bucket_of(r.token)
