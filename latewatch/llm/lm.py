"""Language-model scores by a log-bilinear model trained with noise-contrastive estimation.

Counts of all training tokens are gathered by Spark. The model predicts the class of a token from the class of the token before it: the
``WORDS`` most frequent words and the end are classes of their own, other words share ``BUCKETS`` classes by their last letters; inside such a
class a word has the probability (count + 1) / (tokens + distinct words + 1). Class counts of neighbours, the sufficient statistic of a model
with one word of context, cover the whole training text and are at most the square of the number of classes. The model (context vectors, a matrix, target
vectors, biases) is trained in numpy on them by the expected NCE objective with the class frequencies as noise; a batched matrix product over
all contexts then gives normalised log-probabilities, a table of that same bounded size, which scores every token of every text.

Counts of frequent words (at most ``FREQUENT``) travel to the tasks. Other words are joined: each text's rare words, by 64-bit hash, meet their
counts in a shuffle, so no hot word is shuffled and the vocabulary may have any size.

Null and empty texts are the end token alone. Rows are numbered when the scan is written, so repeated rows and equal or null ids
each get a row; a null id is in the training part. Without training texts all counts are 0. Empty tables give empty results.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch.llm.common import crc_mod, groups, text_batches, written

END = "\n"  # no word holds white space
HELD_OUT_MOD, HELD_OUT = 7, 2
FREQUENT = 65_536
WORDS = 895
BUCKETS = 128
CLASSES = WORDS + 1 + BUCKETS  # words, end, buckets; the end is also the context of a first word
DIMENSION = 24
NOISE = 8.0
PRIOR = 20.0  # tokens with class frequencies that are added to what is seen after each context


def tokens_of(text: str) -> list[str]:
    """Words, A-Z in lower case, and the end."""
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").lower().split()] + [END]


def bucket_of(word: str) -> int:
    return zlib.crc32(word[-3:].encode("utf-8", "surrogatepass")) % BUCKETS


def token_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(token, n) over all texts; counted within tasks before the shuffle."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for part in parts:
            for group in groups(part[text].tolist()):
                for t in group:
                    seen.update(tokens_of(t))
                if len(seen) > 300_000:
                    yield pd.DataFrame({"token": list(seen), "n": list(seen.values())})
                    seen = Counter()
        if seen:
            yield pd.DataFrame({"token": list(seen), "n": list(seen.values())})

    return df.select(text).mapInPandas(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Frequent words with counts and classes, and what the buckets hold. Its size is bounded by ``FREQUENT``."""

    def __init__(self, frequent: list[tuple[str, int]], buckets: dict[int, tuple[int, int]], end_count: int):
        ordered = sorted((x for x in frequent if x[0] != END), key=lambda x: (-x[1], x[0]))
        self.known = {w: (k, n) for k, (w, n) in enumerate(ordered)}
        self.end_count = end_count
        self.bucket_log = np.array([np.log10(sum(buckets.get(b, (0, 0))) + 1) for b in range(BUCKETS)])

    def look_up(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Of distinct tokens: class, count (-1: rare, to be joined), hash."""
        cls, count = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        code = np.zeros(len(words), np.int64)
        for k, w in enumerate(words):
            place, n = self.known.get(w, (FREQUENT, -1))
            if w == END:
                cls[k], count[k] = WORDS, self.end_count
                continue
            cls[k] = place if place < WORDS else WORDS + 1 + bucket_of(w)
            count[k] = n
            if n < 0:
                code[k] = _signed(xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 42))
        return cls, count, code


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _coded(group: list[str]) -> tuple[list[str], list[np.ndarray]]:
    """Distinct tokens of the texts and each text's tokens as places among them."""
    places: dict[str, int] = {}
    out = []
    for t in group:
        tokens = tokens_of(t)
        out.append(np.fromiter((places.setdefault(w, len(places)) for w in tokens), np.int64, len(tokens)))
    return list(places), out


def class_pairs(df: DataFrame, vocabulary, text: str = "text") -> DataFrame:
    """(pair, n): neighbouring classes, coded as context * CLASSES + target, over all texts."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary.value
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for part in parts:
            for group in groups(part[text].tolist()):
                distinct, rows = _coded(group)
                cls = v.look_up(distinct)[0]
                c = np.concatenate([cls[r] for r in rows])  # each text ends with the end, which is the next one's context
                total += np.bincount(np.concatenate([[WORDS], c[:-1]]) * CLASSES + c, minlength=len(total))
        hit = np.flatnonzero(total)
        yield pd.DataFrame({"pair": hit, "n": total[hit]})

    return df.select(text).mapInPandas(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def train(pairs: np.ndarray, counts: np.ndarray, steps: int = 150, rate: float = 0.05, seed: int = 0) -> np.ndarray:
    """log10 P(target class | context class), from class counts of neighbours, by NCE with noise from the class frequencies.

    The score is (context vector x matrix) . target vector + bias. The expectation over the noise is taken exactly, as a matrix.
    """
    n = np.zeros(CLASSES * CLASSES)
    n[pairs] = counts
    n = n.reshape(CLASSES, CLASSES)
    q = n.sum(axis=0) + 0.1
    q /= q.sum()
    rng = np.random.default_rng(seed)
    p = {"r": rng.normal(0, 0.3, (CLASSES, DIMENSION)), "c": np.eye(DIMENSION), "t": rng.normal(0, 0.3, (CLASSES, DIMENSION)), "b": np.log(q)}
    if n.sum():
        n += PRIOR * q
        share = n / n.sum()
        # contexts count by the root of their frequency, so that rare ones are learned, too
        weight = 1 / np.sqrt(share.sum(axis=1, keepdims=True) + 1e-9)
        data, noise = share * weight, NOISE * share.sum(axis=1, keepdims=True) * weight * q
        first, second = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}
        for step in range(1, steps + 1):
            inner = p["r"] @ p["c"]
            delta = inner @ p["t"].T + p["b"] - np.log(NOISE * q)
            s = 1 / (1 + np.exp(-np.clip(delta, -40, 40)))
            g = data * (1 - s) - noise * s
            back = g @ p["t"]
            grad = {"r": back @ p["c"].T, "c": p["r"].T @ back, "t": g.T @ inner, "b": g.sum(axis=0)}
            for k in p:
                first[k] = 0.9 * first[k] + 0.1 * grad[k]
                second[k] = 0.99 * second[k] + 0.01 * grad[k] ** 2
                p[k] = p[k] + rate * (1 - step / (steps + 1)) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-12)
    out = np.empty((CLASSES, CLASSES), np.float32)
    for k in range(0, CLASSES, 256):
        score = p["r"][k : k + 256] @ p["c"] @ p["t"].T + p["b"]
        top = score.max(axis=1, keepdims=True)
        out[k : k + 256] = (score - top - np.log(np.exp(score - top).sum(axis=1, keepdims=True))) / np.log(10)
    return out


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    text_batches(spark)
    rows = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("text"))
    training = rows.where(crc_mod("d", HELD_OUT_MOD) != HELD_OUT)
    counts = written(token_counts(training), "token-counts")
    total, distinct, ends = counts.select(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("token") == END, F.col("n"))), F.lit(0)),
    ).first()

    # the smallest count with at most FREQUENT words from it on, found among a few hundred steps
    step = F.floor(F.log2("n") * 16)
    words, least = 0, None
    for r in sorted(counts.groupBy(step.alias("s")).agg(F.count("*").alias("c"), F.min("n").alias("n")).collect(), key=lambda r: -r["s"]):
        words += r["c"]
        if words > FREQUENT:
            break
        least = r["n"]
    frequent = [tuple(r) for r in counts.where(F.col("n") >= least).collect()] if least is not None else []
    top = {w for w, _ in sorted((x for x in frequent if x[0] != END), key=lambda x: (-x[1], x[0]))[:WORDS]} | {END}
    bucket = F.pmod(F.crc32(F.expr("right(token, 3)").cast("binary")), F.lit(BUCKETS))
    held = counts.where(~F.col("token").isin(*top)).groupBy(bucket.alias("b")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    vocabulary = spark.sparkContext.broadcast(Vocabulary(frequent, {r["b"]: (r["n"], r["v"]) for r in held}, ends))

    pairs = class_pairs(training, vocabulary).toPandas()
    table = spark.sparkContext.broadcast(train(pairs["pair"].to_numpy(np.int64), pairs["n"].to_numpy(np.float64)))

    @F.pandas_udf("n_tokens long, known long, logs double, model double, rare array<long>, times array<int>")
    def scan(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        v, log_p = vocabulary.value, table.value
        for texts in parts:
            out = []
            for group in groups(texts.tolist()):
                distinct_, places = _coded(group)
                cls, count, code = v.look_up(distinct_)
                log_count = np.log10(np.maximum(count, 0) + 1)
                # inside a bucket: log10(count + 1), joined later for rare words, less that of the bucket
                inside = np.where(cls > WORDS, log_count - v.bucket_log[np.maximum(cls - WORDS - 1, 0)], 0.0)
                for p in places:
                    c = cls[p]
                    rare, times = np.unique(code[p[count[p] < 0]], return_counts=True)
                    model = log_p[np.concatenate([[WORDS], c[:-1]]), c].sum(dtype=np.float64) + inside[p].sum()
                    out.append((len(p), int((count[p] > 0).sum()), log_count[p].sum(), model, rare, times.astype(np.int32)))
            yield pd.DataFrame(out, columns=["n_tokens", "known", "logs", "model", "rare", "times"])

    scanned = written(
        rows.select(F.monotonically_increasing_id().alias("row"), "d", scan("text").alias("s")).select("row", "d", "s.*"), "lm-scan",
    )
    rare = scanned.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("h"), F.col("x.times").alias("times"))
    rare_counts = counts.where(F.col("n") < least) if least is not None else counts
    joined = rare.join(rare_counts.select(F.xxhash64("token").alias("h"), F.log10(F.col("n") + 1).alias("log")), "h")
    found = joined.groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("more"), F.sum("times").alias("more_known"))
    more = F.coalesce("more", F.lit(0.0))
    return scanned.join(found, "row", "left").select(
        F.col("d").alias(doc_id), (crc_mod("d", HELD_OUT_MOD) == HELD_OUT).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * float(np.log10(total + distinct + 1))).alias("base_score"), (F.col("model") + more).alias("score"),
    )
