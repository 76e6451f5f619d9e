"""Line de-duplication: shifted passages, byte comparison, order, odd rows, the SQL twin."""

import hashlib
import random

from check_oracle import compare, connect
from pyspark.sql import functions as F

from latewatch.llm import line_dedup as L
from latewatch.llm import queries


def plain_chunks(text):
    lines = (text or "").split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    w = [len([y for y in x.replace("\t", " ").split(" ") if y]) for x in lines]
    out, start = [], 0
    for i in range(len(lines)):
        roll = (h[i - 1] if i else 0) * 31 + h[i]
        if i + 1 == len(lines) or roll % L.DIVISOR == 0 or w[i] > L.LONG or w[i + 1] > L.LONG:
            out.append(("\n".join(lines[start : i + 1]), sum(w[start : i + 1]), i + 1 - start))
            start = i + 1
    return out


def plain(rows):
    """Texts after removal, for distinct (id, text) in order."""
    seen, out = set(), {}
    for i, t in rows:
        keep = []
        for chunk, words, lines in plain_chunks(t):
            if words > L.LONG or (lines > 1 and words >= L.LEAST):
                if chunk in seen:
                    continue
                seen.add(chunk)
            keep.append(chunk)
        out[i] = "\n".join(keep)
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, k string, gone int")
    return L.without_repeats(df)


def test_against_plain(spark):
    rng = random.Random(2)
    lines = [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(rng.choice([0, 1, 4, 9, 60]))) for _ in range(60)]
    passage = [f"line {k} of a passage that is shared by many documents" for k in range(12)]
    rows = []
    for i in range(120):
        own = [rng.choice(lines) + rng.choice(["", f" {i}"]) for _ in range(rng.randrange(9))]
        rows.append((i, "\n".join(own[: len(own) // 2] + (passage if i % 3 == 0 else []) + own[len(own) // 2 :])))
    got = {r.doc_id: r.text for r in run(spark, [(i, t, 0, "x", 1) for i, t in rows]).collect()}
    want = plain(rows)
    assert got == want
    assert sum("line 5 of" in t for t in got.values()) < 5  # the middle of the passage is gone but for its first document


def test_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(5, None), (6, ""), (7, "\n\n"), (1, f"a\n{long}\nb"), (1, f"a\n{long}\nb"), (2, long), (3, f"{long}\n{long}"), (4, "short line"), (8, "short line"), (9, "x\n" * 30_000)]
    out = run(spark, [(i, t, 9, "x", 1) for i, t in rows])
    assert out.columns == ["doc_id", "text", "n_chars", "k", "gone"]
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=lambda r: r[0])
    assert [r[1] for r in got if r[0] == 1] == [f"a\n{long}\nb"] * 2
    rest = {i: t for i, t, _ in got}
    assert rest[2] == "" and rest[3] == "" and rest[4] == rest[8] == "short line" and rest[5] is None and rest[6] == "" and rest[7] == "\n\n"
    assert L.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    nulls = spark.createDataFrame([(None, long), (3, long)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in L.without_repeats(nulls).collect()} == {None: long, 3: ""}


def test_long_texts(spark):
    text = "\n".join(f"line number {k % 700} with some words" for k in range(30_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string").select(F.size(L.chunks(F.col("text"))))
    assert df.collect()[0][0] == len(plain_chunks(text))


def test_twin(spark, sf):
    df = queries.op4_line_dedup(spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert compare(df, connect(sf), queries.SQL["op4_line_dedup"]) == ""
