"""Near-duplicates: sketches, components, exact links by brute force, odd rows."""

import random

import numpy as np
import pytest

from latewatch.llm import near_dedup as N
from latewatch.llm.components import components


def plain_set(text, size):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def plain_components(rows, size):
    """Smallest id reachable, by all pairs."""
    sets = [(i, plain_set(t, size)) for i, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            s, t = sets[x][1], sets[y][1]
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                top[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        least[find(x)] = min(least.get(find(x), i), i)
    return {i: (least[find(x)] if s else i, len(s)) for x, (i, s) in enumerate(sets)}


def copies(rng, n, words=80, vocabulary=5000):
    out = []
    while len(out) < n:
        base = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(1, words))]
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                w[rng.randrange(len(w))] = f"x{rng.randrange(vocabulary)}"
            out.append(rng.choice([" ", "\n", " \t"]).join(w) if rng.random() < 0.9 else " ".join(w).upper())
    return out[:n]


@pytest.mark.parametrize("size", [2, 5])
def test_against_all_pairs(spark, size):
    rng = random.Random(size)
    rows = list(enumerate(copies(rng, 500) + ["", " \n", None, "one", "One", "two words", "Two  words", "a b c d", "a b c d"], start=100))
    got = {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in N.find(spark.createDataFrame(rows, "doc_id long, text string"), size).collect()}
    want = plain_components(rows, size)
    assert {i: g[:2] for i, g in got.items()} == want
    assert all(g[2] == (i == g[0]) for i, g in got.items())


def test_sketch_bound(spark):
    """Pairs at the threshold stay, of whatever size; clearly different ones are set aside."""
    rng = np.random.default_rng(4)
    for size in (5, 20, 60, 150, 600, 3000, 20_000):
        rows = []
        for k in range(120):
            share = 0.8 if k % 2 else 0.65
            both = round(size * 2 * share / (1 + share)) + (share == 0.8)
            x = np.unique(rng.integers(0, 2**63, 2 * size - both, dtype=np.uint64) * np.uint64(2))
            s, t = np.sort(x[rng.permutation(len(x))][: size]), None
            rest = np.setdiff1d(x, s)
            t = np.sort(np.concatenate([rng.permutation(s)[:both], rest]))
            (hs, bs), (ht, bt) = N.sketch(s), N.sketch(t)
            z = sum(int(v).bit_count() for v in (bs ^ bt).view(np.uint64))
            rows.append((share, z, len(s) + len(t), hs + ht))
        df = spark.createDataFrame([(float(a), int(z), int(n), int(h)) for a, z, n, h in rows], "share double, z long, n long, h long")
        out = df.select("share", (df.z <= N.most_bits(df.n, df.h)).alias("stays")).collect()
        assert all(r.stays for r in out if r.share == 0.8), size
        if 150 <= size <= 3000:
            assert not any(r.stays for r in out if r.share == 0.65), size


def test_components(spark):
    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000 + 2 * k, 5001 + 2 * k) for k in range(50)] + [(7, 7)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(201)) and all(got[1000 + k] == 1000 for k in range(300)) and all(got[5001 + 2 * k] == 5000 + 2 * k for k in range(50))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stage_and_odd_rows(spark):
    t = " ".join(f"w{k}" for k in range(60))
    rows = [(3, t, "a"), (3, t, "a"), (4, t + " z", "b"), (5, None, "c"), (6, "", "d"), (None, t, "e"), (None, "alone in the world", "f"), (9, "other text of some words", "node")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    kept = N.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.node) for r in kept.collect()) == [("3", "a"), ("5", "c"), ("6", "d"), ("9", "node"), ("None", "f")]
    assert N.keep_one(df.limit(0)).count() == 0 and N.find(df.limit(0)).count() == 0


def test_long_text(spark):
    rng = random.Random(1)
    words = [str(rng.randrange(10**6)) for _ in range(60_000)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[100:])), (3, " ".join(words[:30_000]))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in N.find(df).collect()} == {1: 1, 2: 1, 3: 3}
