"""Source divergence against brute force and the SQL twin, at any cut into slices, shards and blocks."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from check_oracle import compare, connect
from conftest import rows

from latewatch.llm import queries, source_audit
from pyspark.sql import functions as F

SCHEMA = "text string, lang string, source string, item string, value string, n long"


def brute(docs, least=30, top=50):
    docs = [tuple(x or "" for x in d) for d in docs]
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    found = [[m.translate(lower) for m in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)] for t, _, _ in docs]
    out = []
    for lang in {d[1] for d in docs}:
        df, total = Counter(), Counter()
        by = defaultdict(Counter)
        for (_, l, s), terms in zip(docs, found):
            if l == lang:
                by[s].update(terms)
                total.update(terms)
                df.update(set(terms))
        kept = [t for t, n in df.items() if n >= least]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * len(kept)) for t in kept}
        q, p = share(total), {s: share(c) for s, c in by.items()}
        for s in by:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in by if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if by[s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                for r, (item, v) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit], 1):
                    out.append((lang, s, part, item, v, r))
    return sorted(out, key=repr)


def made(n, sources, seed=3):
    rng = random.Random(seed)
    words = ["The", "the", "épée", "ÉPÉE", "a1b", "x-y", "漢字", "é", "z\x00q", "Ａ"] + [f"w{chr(97 + i)}" for i in range(15)]
    out = []
    for _ in range(n):
        s = rng.randrange(sources)
        text = " ".join(rng.choice(words[s % 5 :]) for _ in range(rng.randrange(12)))
        out.append((text, rng.choice(["en", "fr"]), f"s{s if rng.random() < 0.6 else 0}"))
    return out + [(None, None, None), ("", "", "x"), ("only one", "xx", "s"), ("123", "none", "a"), ("", "none", "b"), (None, "en", "empty"), ("A" * 50_000 + " the", "en", "s1")]


@pytest.mark.parametrize("block, terms, slice_bytes", [(500, 1000, 16_000_000), (3, 5, 300), (1, 1, 1)])
def test_brute_force(spark, monkeypatch, block, terms, slice_bytes):
    monkeypatch.setattr(source_audit, "BLOCK", block)
    monkeypatch.setattr(source_audit, "TERMS", terms)
    docs = made(300, 8)
    df = spark.createDataFrame([(*d, "x", "y", 7) for d in docs], SCHEMA).repartition(5)
    assert rows(source_audit.audit(df, least_docs=5, top=4)) == brute(docs, 5, 4)
    # the cut into slices changes nothing once counts are added up
    monkeypatch.setattr(source_audit, "SLICE_BYTES", slice_bytes)
    known = pa.RecordBatch.from_pylist([{"text": t or "", "lang": l or "", "source": s or ""} for t, l, s in docs])
    total = Counter()
    for t in source_audit._tables(iter([known.slice(0, 100), known.slice(100)])):
        for r in source_audit.count_terms(t).to_pylist():
            total[r["lang"], r["source"], r["term"]] += r["n"]
    want = {(r.lang, r.source, r.term): r.n for r in source_audit.term_counts(df).collect()}
    assert dict(total) == want


def test_shares_are_exact(spark):
    values = [(0, 1, 1), (5 * 10**14, 6 * 10**14, 3), (7, 9 * 10**14, 10**6), (999, 1000, 1)]
    df = spark.createDataFrame(values, "n long, total long, v long").select("n", "total", "v", source_audit.share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    assert all(r.p == 1 + 10**9 * (r.n + 5) // (r.total + 5 * r.v) for r in df.collect())


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([("the", "en", "a", "", "", 1)] * 40 + [("the", "en", "b", "", "", 1)] * 40, SCHEMA)
    assert rows(source_audit.audit(df)) == brute([("the", "en", "a")] * 40 + [("the", "en", "b")] * 40)
    assert source_audit.audit(df.limit(0)).collect() == []


def test_twin(spark, sf):
    assert compare(queries.op12_source_audit(spark, sf), connect(sf), queries.SQL["op12_source_audit"]) == ""
