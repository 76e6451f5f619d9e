"""Quality rules: statistics against plain Python, the learner, odd rows."""

import random
import re
from collections import Counter

from latewatch.llm import queries
from latewatch.llm import rules as R


def plain(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    seen, inside = Counter(windows), set()
    for k, w in enumerate(windows):
        if seen[w] > 1:
            inside |= set(range(k, k + 8))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside)


def test_statistics(spark):
    rng = random.Random(5)
    texts = [None, "", " ", "\n\n \n", "a", "a b c d e f g h", "x " * 50, "a b c d e f g h i " * 3 + "z", "\x0b\x0c\r\t", "é#|", "a b c\x1cd", "w" * 100_000]
    for _ in range(200):
        texts.append("".join(rng.choice(["a", "b", "c", "c d e f", " ", " ", "\n", "#", "\t", "é"]) for _ in range(rng.randrange(120))))
    long = [str(rng.randrange(10**6)) for _ in range(20_000)]
    texts.append(" ".join(long + long[500:700] + long[:50]))
    df = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, w string")
    for r in R.with_statistics(df).collect():
        s = r.statistics
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == plain(texts[r.doc_id]), repr(texts[r.doc_id])[:100]


def test_learner():
    rng = random.Random(7)
    rows = []
    for _ in range(900):
        v = [rng.random() for _ in R.STATISTICS]
        rows.append((tuple(v), 0 if (v[2] > 0.8 and v[5] > 0.5) or v[7] < 0.1 else 1))
    rules = R.learn(rows)
    reject = lambda v: any(all(lit.holds(v[R.STATISTICS.index(lit.statistic)]) for lit in rule) for rule in rules)
    assert 2 <= len(rules) and max(map(len, rules)) <= 3
    assert sum(reject(v) == (y == 0) for v, y in rows) > 0.95 * len(rows)
    assert R.learn([]) == [] and R.learn([((0.0,) * 9, 1)] * 50) == [] and R.learn([((0.0,) * 9, 0), ((0.0,) * 9, 1)] * 50) == []


def test_verdict_is_the_ordered_list(spark):
    rules = [(R.Literal("n_words", True, 5.0), R.Literal("symbol_share", True, 0.1)), (R.Literal("n_words", False, 1.0),)]
    df = spark.createDataFrame([(6.0, 0.2), (6.0, 0.0), (1.0, 0.0), (2.0, 0.5)], "n_words double, symbol_share double")
    assert [r[0] for r in df.select(R.verdict(rules)).collect()] == [False, True, False, True]


def test_query(spark, sf):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    df = queries.op10_rules(spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    rows = df.collect()
    assert len(rows) == len(texts)
    for r in rows:
        p = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == p
        assert r.base_failed == (p[0] < 20 or 100 * p[4] > 30 * p[0]) and not (r.base_failed and r.kept)
        assert r.base_failed or r.kept or labels.get(r.doc_id) != 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert R.with_statistics(df).count() == 0
    assert R.train(R.with_statistics(df), spark.createDataFrame([], "doc_id long, quality int")) == []


def test_hash_sample(spark):
    from latewatch.llm.common import hash_sample

    df = spark.range(5000)
    rows = hash_sample(df, "id", 700)
    assert len(rows) == 700 and rows == hash_sample(df.repartition(7), "id", 700)
    every = sorted(hash_sample(df, "id", 10_000), key=lambda r: (r["_h"], r["id"]))
    assert len(every) == 5000 and rows == every[:700]
    assert hash_sample(df.limit(0), "id", 5) == []
