"""Languages of a text as a mixture, by expectation-maximisation over its words.

Words (runs of letters in lower case, in pieces of at most ``UNIT`` letters) are the observations. The likelihood of a word in a language is that of its code
points, each given the two before it, with counts of trigrams and of their contexts hashed into ``TRIGRAMS`` and ``CONTEXTS`` buckets.
Tasks count the buckets of all training texts; the model is that table, of one column per language, whatever the size of the corpus.

For a text, EM estimates the proportions of a set of languages: the share of each word that belongs to each language, and the mean of these shares,
in turns. The set grows from the single likeliest language by the one with the steepest likelihood, as long as the log-likelihood
gains more than ``PENALTY`` times the logarithm of the number of words, per language. As the log-likelihood is concave in the proportions,
its gradient bounds what any other language can still gain, so most texts end without a further run. Texts are worked on together, as
segments of one matrix.

``lang_pred`` is the language with the largest share (of equal ones the first by name), ``score`` that share, drawn to the uniform one by the weight of one word.
Null texts and texts without a letter are ``und`` with score 0 and no languages, and so is every text if nothing could be learned. Rows without a language
are not learned from; a null id is in no held-out fold. Repeated rows each count and each get a result. Empty tables give empty results; other
columns are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch.llm.common import GROUP_CHARS, crc_mod, groups, text_batches

HELD_OUT_MOD, HELD_OUT = 4, 2
UNDETERMINED = "und"
UNIT = 32
TRIGRAMS, CONTEXTS = 1 << 17, 1 << 14
PSEUDO = 0.5  # added to each trigram, of which a context is taken to have ALPHABET
ALPHABET = 64
PENALTY = 3.0
ROUNDS = 60
CLOSE = 1e-4  # shares that move less are final
STORE = 100_000  # words with likelihoods that a worker keeps; it starts afresh when the store is full
_UNITS = re.compile(r"[^\W\d_]{1,%d}" % UNIT)
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def units(text: str) -> Iterator[list[str]]:
    """Words in lists; a long text is not held as one list."""
    text = text.lower()
    if len(text) <= GROUP_CHARS:
        yield _UNITS.findall(text)
        return
    found = (m.group() for m in _UNITS.finditer(text))
    while part := list(islice(found, 100_000)):
        yield part


def has_letter(word: str) -> bool:
    """Superscripts and the like are matched as well, but are no letters."""
    return word.isalpha() or any(c.isalpha() for c in word)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all trigrams of some words, with two spaces before a word and one after it: their buckets, those of their contexts, and where each word starts."""
    c = np.frombuffer(("  " + "  ".join(words) + "  ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    a, b, d = c[:-2], c[1:-1], c[2:]
    real = (b != 32) | (a == 32)
    a, b, d = a[real], b[real], d[real]
    context = a * _K[0] + b * _K[1]
    gram = (context ^ (d * _K[2])) * _K[3]
    return (gram >> np.uint64(47)).astype(np.int64), ((context * _K[3]) >> np.uint64(50)).astype(np.int64), np.flatnonzero((a == 32) & (b == 32))


def gram_counts(df: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, bucket, n) over all rows with a language; contexts come after the trigrams."""

    def counted(seen: dict[str, dict[str, int]]) -> pd.DataFrame:
        parts = []
        for name, words in seen.items():
            bucket, n = np.empty(0, np.int64), np.empty(0)
            if words:
                gram, context, starts = grams(list(words))
                weight = np.repeat(np.fromiter(words.values(), np.float64, len(words)), np.diff([*starts, len(gram)]))
                total = np.bincount(np.concatenate([gram, TRIGRAMS + context]), np.concatenate([weight, weight]))
                bucket = np.flatnonzero(total)
                n = total[bucket]
            # a language without a word is learned, too: its name is kept by a bucket of its own
            parts.append(pd.DataFrame({"lang": name, "bucket": np.append(bucket, -1), "n": np.append(n, 0).astype(np.int64)}))
        return pd.concat(parts)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, dict[str, int]] = {}
        for part in parts:
            for name, t in zip(part["lang"], part["text"], strict=True):
                words = seen.setdefault(name, {})
                for some in units(t or ""):
                    for w in some:
                        words[w] = words.get(w, 0) + 1
                if sum(map(len, seen.values())) > 3 * STORE:
                    yield counted(seen)
                    seen = {}
        if seen:
            yield counted(seen)

    text_batches(df.sparkSession)
    known = df.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    return known.mapInPandas(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Mixture:
    def __init__(self, languages: list[str], logs: np.ndarray):
        """``logs``: one column per language; rows are buckets of trigrams, then of contexts."""
        self.languages, self.logs = languages, logs
        self._start()

    @classmethod
    def learned(cls, counts: pd.DataFrame) -> Mixture:
        languages = sorted(counts["lang"].unique())
        n = np.zeros((TRIGRAMS + CONTEXTS, len(languages)), np.float32)
        real = counts[counts["bucket"] >= 0]
        n[real["bucket"], np.searchsorted(np.array(languages, object), real["lang"].to_numpy(object))] = real["n"]
        n[:TRIGRAMS] += PSEUDO
        n[TRIGRAMS:] += PSEUDO * ALPHABET
        return cls(languages, np.log(n))

    def __getstate__(self):
        return {"languages": self.languages, "logs": self.logs}

    def __setstate__(self, state):
        self.__init__(**state)

    def _start(self) -> None:
        self.places: dict[str, int] = {}
        self.stored = np.empty((1024, len(self.languages)), np.float32)

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """Log-likelihood of each word in each language."""
        gram, context, starts = grams(words)
        out = [np.add.reduceat(self.logs[gram, k] - self.logs[TRIGRAMS + context, k], starts) for k in range(len(self.languages))]
        return np.stack(out, axis=1)

    def rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words of each text, all texts together: (text, count, log-likelihoods), ordered by text."""
        if len(self.places) > STORE:
            self._start()
        first, new, places = len(self.places), [], self.places
        doc, place, count = [], [], []
        for k, t in enumerate(texts):
            seen: dict[str, int] = {}
            for some in units(t):
                for w in some:
                    seen[w] = seen.get(w, 0) + 1
            for w in seen:
                if w not in places:
                    places[w] = first + len(new)
                    new.append(w)
            here = [places[w] for w in seen]
            doc.append(np.full(len(here), k))
            place.append(np.array(here, np.int64))
            count.append(np.fromiter(seen.values(), np.float64, len(seen)))
        while len(self.stored) < first + len(new):
            self.stored = np.concatenate([self.stored, np.empty_like(self.stored)])
        for k in range(0, len(new), 50_000):
            part = new[k : k + 50_000]
            values = self.likelihoods(part)
            values[[not has_letter(w) for w in part]] = np.nan
            self.stored[first + k : first + k + len(part)] = values
        doc, place, count = (np.concatenate(x) if x else np.empty(0) for x in (doc, place, count))
        logs = self.stored[place.astype(np.int64)].astype(np.float64)
        letters = ~np.isnan(logs[:, 0])
        return doc[letters].astype(np.int64), count[letters], logs[letters]

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Proportion of each language in each text (rows of zeros: no words), and the number of words."""
        doc, count, logs = self.rows(texts)
        out, words = np.zeros((len(texts), len(self.languages))), np.bincount(doc, count, len(texts))
        if not len(doc):
            return out, words
        logs -= logs.max(axis=1, keepdims=True)
        ids, starts = np.unique(doc, return_index=True)
        n = words[ids]
        single = np.add.reduceat(count[:, None] * logs, starts)
        best = single.argmax(axis=1)
        p = np.exp(logs)
        pi, fit = np.zeros_like(single), single[np.arange(len(ids)), best]
        pi[np.arange(len(ids)), best] = 1.0
        penalty = PENALTY * np.log(1 + n)
        live = np.arange(len(ids))
        while len(live):
            # what the steepest language outside of the set can gain at most
            part, at, first = _segments(live, starts, len(doc))
            mix = np.einsum("rl,rl->r", pi[live][at], p[part])
            slope = np.add.reduceat(count[part, None] * (p[part] / np.maximum(mix, 1e-300)[:, None]), first)
            slope[pi[live] > 0] = -np.inf
            more = slope.argmax(axis=1)
            go = slope[np.arange(len(live)), more] - n[live] > penalty[live]
            live, more = live[go], more[go]
            if not len(live):
                break
            part, at, first = _segments(live, starts, len(doc))
            trial = pi[live]
            k = (trial > 0).sum(axis=1)
            trial *= (k / (k + 1))[:, None]
            trial[np.arange(len(live)), more] = 1 / (k + 1)
            trial, value = _em(trial, p[part], count[part], at, first)
            better = value - fit[live] > penalty[live]
            live = live[better]
            pi[live], fit[live] = trial[better], value[better]
        out[ids] = pi
        return out, words

    def predict(self, texts: list[str]) -> list[tuple]:
        if not self.languages:
            return [(UNDETERMINED, 0.0, [])] * len(texts)
        share, words = self.shares(texts)
        out = []
        for s, n in zip(share, words, strict=True):
            if not n:
                out.append((UNDETERMINED, 0.0, []))
                continue
            order = [k for k in np.argsort(-s, kind="stable") if s[k] > 0]
            top = order[0]
            score = (n * s[top] + 1 / len(self.languages)) / (n + 1)
            out.append((self.languages[top], float(score), [{"lang": self.languages[k], "share": float(s[k])} for k in order]))
        return out


def _segments(live: np.ndarray, starts: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of some texts: their places, the text of each (as a place in ``live``), and where each text begins."""
    size = np.diff([*starts, total])[live]
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    at = np.repeat(np.arange(len(live)), size)
    return np.arange(size.sum()) - first[at] + starts[live][at], at, first


def _em(pi: np.ndarray, p: np.ndarray, count: np.ndarray, at: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions that maximise the likelihood over the languages with a share, and its logarithm, of all texts at once."""
    n = np.add.reduceat(count, first)
    for _ in range(ROUNDS):
        part = pi[at] * p
        mix = np.maximum(part.sum(axis=1), 1e-300)
        new = np.add.reduceat(part * (count / mix)[:, None], first) / n[:, None]
        moved = np.abs(new - pi).max()
        pi = new / new.sum(axis=1, keepdims=True)
        if moved < CLOSE:
            break
    mix = np.maximum(np.einsum("rl,rl->r", pi[at], p), 1e-300)
    return pi, np.add.reduceat(count * np.log(mix), first)


def train(rows: DataFrame, lang: str = "lang", text: str = "text") -> Mixture:
    """The model of all rows with a language. What reaches the driver is bounded by buckets times languages."""
    return Mixture.learned(gram_counts(rows, lang, text).toPandas())


def predict(df: DataFrame, model: Mixture, text: str = "text") -> DataFrame:
    """``df`` with ``language``: struct of ``lang_pred``, ``score`` and ``languages`` (those of the set with their shares, the largest first)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, languages array<struct<lang: string, share: double>>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in parts:
            limit = max(50_000, GROUP_CHARS * 8 // max(8, len(m.languages)))
            out = [x for group in groups(texts.tolist(), limit) for x in m.predict(group)]
            yield pd.DataFrame(out, columns=["lang_pred", "score", "languages"])

    text_batches(df.sparkSession)
    return df.withColumn("language", run(F.col(text)))


def held_out(doc_id: str = "doc_id"):
    return crc_mod(doc_id, HELD_OUT_MOD) == HELD_OUT


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with ``held_out`` and ``language``, learned from the rows that are not held out."""
    return predict(docs.withColumn("held_out", held_out(doc_id)), train(docs.where(~held_out(doc_id)), lang, text), text)
