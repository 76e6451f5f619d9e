"""Language mixtures: held-out accuracy, a plain version of model and selection, mixed texts, odd rows."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from latewatch.llm import langid, queries

M = (1 << 64) - 1
K = [int(k) for k in langid._K]


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def plain_words(text):
    runs = re.findall(r"[^\W\d_]+", text.lower())
    return [p for r in runs for p in (r[k : k + 32] for k in range(0, len(r), 32)) if any(c.isalpha() for c in p)]


def plain_grams(word):
    c = [32, 32, *map(ord, word), 32]
    for x, y, z in zip(c, c[1:], c[2:]):
        context = (x * K[0] + y * K[1]) & M
        yield (((context ^ (z * K[2] & M)) * K[3]) & M) >> 47, ((context * K[3]) & M) >> 50


class Plain:
    def __init__(self, rows):
        self.gram, self.context = defaultdict(Counter), defaultdict(Counter)
        for text, lang in rows:
            self.gram[lang]
            for w in plain_words(text):
                for g, c in plain_grams(w):
                    self.gram[lang][g] += 1
                    self.context[lang][c] += 1
        self.langs = sorted(self.gram)

    def word(self, w):
        return [sum(math.log((self.gram[x][g] + 0.5) / (self.context[x][c] + 32)) for g, c in plain_grams(w)) for x in self.langs]

    def fit(self, rows, chosen):
        """Shares of the chosen languages that maximise the likelihood, by very many plain steps."""
        pi = {k: 1 / len(chosen) for k in chosen}
        n = sum(c for c, _ in rows)
        for _ in range(2000):
            total = dict.fromkeys(chosen, 0.0)
            for c, p in rows:
                mix = sum(pi[k] * p[k] for k in chosen)
                for k in chosen:
                    total[k] += c * pi[k] * p[k] / mix
            pi = {k: v / n for k, v in total.items()}
        return pi, sum(c * math.log(sum(pi[k] * p[k] for k in chosen)) for c, p in rows)

    def best_set(self, text):
        """The set of languages of the best penalised likelihood among all sets."""
        rows = []
        for w, c in Counter(plain_words(text)).items():
            logs = self.word(w)
            rows.append((c, [math.exp(x - max(logs)) for x in logs]))
        penalty = langid.PENALTY * math.log(1 + sum(c for c, _ in rows))
        fits = []
        for size in range(1, len(self.langs) + 1):
            for chosen in itertools.combinations(range(len(self.langs)), size):
                pi, value = self.fit(rows, chosen)
                fits.append((value - penalty * size, {self.langs[k]: v for k, v in pi.items()}))
        return max(fits, key=lambda x: x[0])[1]


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()]


def test_held_out(spark, docs):
    got = {r.doc_id: r for r in queries.op11_langid(spark, "/root/testdata/sf0.01").collect()}
    assert set(got) == {d[0] for d in docs}
    assert all(got[d].held_out == held(d) and 0 <= got[d].score <= 1 for d in got)
    right = [got[d].lang_pred == lang for d, _, lang in docs if held(d)]
    assert sum(right) / len(right) > 0.98 and len(right) > 150


def test_model_and_sets(spark, docs):
    """Counts, likelihoods and the chosen sets equal those of a plain version that tries every set of languages."""
    rows = [(t, lang) for d, t, lang in docs if not held(d)][:150]
    plain = Plain(rows)
    model = langid.train(spark.createDataFrame(rows, "text string, lang string").repartition(7))
    assert model.languages == plain.langs
    words = ["the", "être", "schön", "años", "x" * 32, "漢字", "a"]
    assert np.allclose(model.likelihoods(words), [plain.word(w) for w in words], atol=1e-3)
    by = defaultdict(list)
    for d, t, lang in docs:
        if held(d) and 200 < len(t) < 1200:
            by[lang].append(t)
    rng = random.Random(4)
    texts = [rng.choice(by[a]) for a in by for _ in range(2)] + [rng.choice(by[a]) + "\n" + rng.choice(by[b]) for a, b in itertools.combinations(sorted(by), 2)]
    texts.append(" ".join(rng.choice(by[a]) for a in sorted(by)[:3]))
    for text, got in zip(texts, model.predict(texts), strict=True):
        want = plain.best_set(text)
        mine = {x["lang"]: x["share"] for x in got[2]}
        assert mine.keys() == want.keys() and all(abs(mine[k] - want[k]) < 0.02 for k in want)
        assert got[0] == max(want, key=want.get)


def test_mixed_texts(spark, docs):
    model = langid.train(spark.createDataFrame([(t, lang) for d, t, lang in docs if not held(d)], "text string, lang string"))
    by = {lang: [t for d, t, x in docs if held(d) and x == lang and len(t) > 400] for lang in ("de", "en", "es", "fr")}
    rng, right, errors = random.Random(2), 0, []
    for _ in range(60):
        a, b = rng.sample(sorted(by), 2)
        x, y = rng.choice(by[a]), rng.choice(by[b])
        share = dict((s["lang"], s["share"]) for s in model.predict([x + "\n" + y])[0][2])
        right += share.keys() == {a, b}
        errors.append(abs(share.get(a, 0) - len(x.split()) / len((x + " " + y).split())))
    assert right >= 51 and np.mean(errors) < 0.05


def test_cuts_do_not_matter(spark, docs, monkeypatch):
    model = langid.train(spark.createDataFrame([(t, lang) for d, t, lang in docs[:400]], "text string, lang string"))
    texts = [t for _, t, _ in docs[400:450]] + ["", "1²", "word " * 5000, "漢" * 3000]
    want = model.predict(texts)
    monkeypatch.setattr(langid, "GROUP_CHARS", 100)  # every longer text is read piecewise
    monkeypatch.setattr(langid, "STORE", 30)
    got = [model.predict([t])[0] for t in texts]
    assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-3)


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, language_ string, held string"
    df = spark.createDataFrame(
        [(i, "the cat sat on the mat", "en", "x", "y") for i in range(20)] + [(i, "le chat est sur la table", "fr", "x", "y") for i in range(20)]
        + [(None, "the mat", "en", "", ""), (50, None, "en", "", ""), (51, "", None, "", ""), (52, "12 ² ½ _ !", "fr", "", ""), (53, "x", None, "", ""),
           (54, None, "xx", "", ""), (55, "THE CAT " * 60_000, None, "", "")], schema)
    out = langid.identify(df)
    assert out.columns == [*df.columns, "held_out", "language"]
    got = [(r.doc_id, r.text, r.held_out, r.language.lang_pred, r.language.score, len(r.language.languages)) for r in out.collect()]
    assert len(got) == 47
    for d, text, out_, lang, score, n in got:
        if d in (50, 51, 52, 54):
            assert (lang, score, n) == ("und", 0.0, 0)
        elif text and "the" in text.lower():
            assert lang == "en" and score > 0.5
        elif text and "chat" in text:
            assert lang == "fr"
        assert out_ == (d is not None and held(d))
    assert langid.identify(df.limit(0)).collect() == []
    nothing = langid.identify(df.withColumn("lang", df.lang.substr(0, 0).cast("string")).selectExpr("doc_id", "text", "cast(null as string) lang")).collect()
    assert {r.language.lang_pred for r in nothing} == {"und"}
