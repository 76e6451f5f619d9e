"""Quality scores by histogram gradient-boosted trees over document statistics.

Each whole text becomes a row of statistics (lengths, classes of characters, repetition of words and lines); nothing else
is an input. Trees are grown level by level from histograms of gradients over quantile bins, flattened into arrays of
complete binary trees, and walked for all rows of a batch at once.

Training uses labelled rows outside the held-out fold, at most ``SAMPLE`` of them (those with the smallest hash of the id,
ties by id and statistics), so the driver's share is bounded; statistics and scores cover all rows. Null ids and null
labels do not train; several labels of one id each count. Without labelled rows every score is the prior, one half.
Null and empty texts have the statistics of an empty text and are scored too. Repeated rows get equal scores, empty tables give
empty results, other columns stay as they are.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch.llm.common import crc_mod, hash_sample, text_batches, written

SAMPLE = 20_000
HELD_OUT_MOD = 5
THRESHOLD = 0.3

STATISTICS = [
    "log_chars", "log_words", "mean_word", "words_per_line", "upper", "digit", "space", "mark", "bang", "symbol", "other", "bar",
    "distinct_words", "top_word", "same_as_before", "same_pair", "duplicate_lines", "short_lines",
]
_CLASSES = {"lower": 0, "upper": 1, "digit": 2, "space": 3, "mark": 4, "bang": 5, "symbol": 6, "other": 7, "bar": 8}


def _class_of(code: int) -> int:
    c = chr(code)
    if c == "|":
        return 8
    if c in "!?":
        return 5
    if c in "#*$%&<>@=^~_\\/+{}[]":
        return 6
    if c.isspace():
        return 3
    if c in ".,;:'\"-()":
        return 4
    kind = unicodedata.category(c)
    return 1 if kind == "Lu" else 0 if kind[0] in "LM" else 2 if kind[0] == "N" else 7


_CLASS = np.array([_class_of(c) for c in range(0x3000)] + [7], np.uint8)


def statistics(text: str | None) -> np.ndarray:
    text = text or ""
    out = np.zeros(len(STATISTICS), np.float32)
    if not text:
        return out
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    share = np.bincount(_CLASS[np.minimum(codes, 0x3000)], minlength=9) / len(codes)
    words, lines = text.split(), text.split("\n")
    n = len(words)
    out[:2] = np.log1p(len(text)), np.log1p(n)
    out[4:12] = share[[1, 2, 3, 4, 5, 6, 7, 8]]
    if n:
        counts: dict[str, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        out[2] = len(text) / n
        out[3] = n / len(lines)
        out[12], out[13] = len(counts) / n, max(counts.values()) / n
        out[14] = sum(map(str.__eq__, words, words[1:])) / n
        out[15] = 1 - len(set(zip(words, words[1:], strict=False))) / max(1, n - 1)
        full = [x for x in lines if x.strip()]
        out[16], out[17] = 1 - len(set(full)) / len(full), sum(len(x) < 30 for x in full) / len(full)
    return out


class Trees:
    """Boosted complete binary trees: ``feature``, ``cut`` (trees, inner nodes), ``value`` (trees, leaves), ``start``."""

    def __init__(self, feature, cut, value, start, depth):
        self.feature, self.cut, self.value, self.start, self.depth = feature, cut, value, start, depth

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 5.0) -> Trees:
    """Second-order boosting on the logistic loss. ``least``: smallest sum of second derivatives in a child."""
    inner, leaves = 2**depth - 1, 2**depth
    if not len(y):
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), 0.0, depth)
    x = x.astype(np.float64)
    d = x.shape[1]
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(d)]
    code = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1)  # code > c: x > edges[c]
    mean = (y.sum() + 0.5) / (len(y) + 1)
    total = np.full(len(y), np.log(mean / (1 - mean)))
    start, features, cuts, values = float(total[0]), [], [], []
    offset = np.arange(d) * bins
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        feature, cut, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            width = 2**level
            at = ((node - width + 1)[:, None] * (d * bins) + offset + code).ravel()
            sums = [np.bincount(at, weights=np.repeat(v, d), minlength=width * d * bins).reshape(width, d, bins).cumsum(axis=2) for v in (g, h)]
            gl, hl = sums
            ga, ha = gl[:, :1, -1:], hl[:, :1, -1:]
            gain = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
            gain[(hl < least) | (ha - hl < least)] = -np.inf
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                f, c = divmod(int(best[k]), bins)
                if gain[k, f, c] > 1e-9 and c < len(edges[f]):
                    feature[width - 1 + k], cut[width - 1 + k] = f, edges[f][c]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, weights=g, minlength=leaves) / (np.bincount(leaf, weights=h, minlength=leaves) + ridge)
        total += value[leaf]
        features.append(feature)
        cuts.append(cut)
        values.append(value)
    return Trees(np.array(features), np.array(cuts), np.array(values), start, depth)


def with_statistics(df: DataFrame, text: str = "text", out: str = "statistics") -> DataFrame:
    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([statistics(t) for t in texts], dtype=object)

    text_batches(df.sparkSession)
    return df.withColumn(out, run(F.col(text)))


def train(stats: DataFrame, labels: DataFrame, held_out_mod: int = HELD_OUT_MOD, sample: int = SAMPLE) -> Trees:
    """``stats``: doc_id and statistics; ``labels``: doc_id and quality."""
    known = labels.where("quality IN (0, 1)").where(crc_mod("doc_id", held_out_mod) > 0).select(F.col("doc_id").alias("_id"), F.col("quality").alias("_y"))
    rows = hash_sample(stats.join(known, F.col("doc_id") == F.col("_id")).select("_id", "statistics", "_y"), "_id", sample, "statistics", "_y")
    x = np.array([r["statistics"] for r in rows], np.float64).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([r["_y"] for r in rows], np.float64))


def _scored(model: Trees):
    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            x = np.stack(s.to_numpy()).astype(np.float64) if len(s) else np.zeros((0, len(STATISTICS)))
            yield pd.Series(model.score(x))

    return run


def _scored_text(model: Trees):
    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            x = np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(STATISTICS))
            yield pd.Series(model.score(x) if len(texts) else np.zeros(0))

    return run


def predicted(score: Column) -> Column:
    return F.when(score >= THRESHOLD, 1).otherwise(0)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. The statistics are computed once and written."""
    stats = written(with_statistics(docs.select("doc_id", "text")).select("doc_id", "statistics"), "quality-statistics")
    score = _scored(train(stats, labels))
    out = stats.select("doc_id", (crc_mod("doc_id", HELD_OUT_MOD) == 0).alias("held_out"), score("statistics").alias("score"))
    return out.withColumn("predicted", predicted(F.col("score")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their columns. Texts do not move: statistics of labelled rows
    train the model, then each row is scored where it is read."""
    stats = written(with_statistics(docs.select("doc_id", "text")).select("doc_id", "statistics"), "quality-statistics")
    model = train(stats, labels)
    return docs.where(predicted(_scored_text(model)(F.col("text"))) == 1)

