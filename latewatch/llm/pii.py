"""Personal data: fixed base patterns, and identifiers found by their contexts (bootstrapping).

Base kinds are matched exactly as stated in ``base_spans``. They are the seeds: the words around each of them form lexical
patterns (the two words before; the word before and the word after). All tokens with a digit or an ``@`` outside base
spans are unlabelled instances with the same kinds of patterns. Spark holds the graph of distinct pattern-instance edges
and scores it in rounds: a pattern's confidence in a kind is the share of that kind among all instances it occurs with,
an instance takes the kind of its best confident pattern if its shape allows that kind, and counts for patterns in the next
round. Instances beside a confident pattern become spans of its kind.

Null and empty texts have no spans. Rows are told apart by a number given when the first pass is written, so repeated rows
and equal, null or repeated ids each give a row of their own. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch.llm.common import text_batches, written

KINDS = ("email", "ip", "card", "phone")  # in the order of the contract
MIN_SUPPORT = 3.0  # distinct instances of a kind (as a sum of confidences) that a pattern needs
MIN_CONFIDENCE = 0.7
ROUNDS = 2

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_EDGE = " \t\r\n.,;:!?()[]{}<>\"'|"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: each ``@`` in turn, with the longest run of local characters since the last match before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        k = at
        while k > end:  # back over the run, 64 characters at a time
            piece = text[max(end, k - 64) : k]
            rest = len(piece.rstrip(_LOCAL))
            k -= len(piece) - rest
            if rest:
                break
        if k < at and (m := _DOMAIN.match(text, at + 1)):
            yield k, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) in code points, end exclusive, by start and then by kind as listed."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in _emails(text)]
    if _MARK.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    return [(s, KINDS[k], e) for s, k, e in sorted(out)]


def _shape(token: str) -> int:
    """Bit set of the kinds that an unlabelled token may be of."""
    digits = sum(c in "0123456789" for c in token)
    out = ("@" in token) << 0
    if digits >= 4 and not token.strip("0123456789.:"):
        out |= 1 << 1
    if 12 <= digits <= 22 and not token.strip("0123456789-."):
        out |= 1 << 2
    if 7 <= digits <= 15 and not token.strip("0123456789-.()+/"):
        out |= 1 << 3
    return out


def _context(text: str, start: int, end: int) -> tuple[str, str]:
    """The two patterns of a place: two words before; one before and one after. Case and digits are levelled."""
    level = lambda words: [re.sub("[0-9]", "0", w.lower()) for w in words]
    left = ["", "", *level(text[max(0, start - 60) : start].split()[-2:])][-2:]
    right = [*level(text[end : end + 40].split()[:1]), ""][0]
    return f"{left[0]} {left[1]} _", f"{left[1]} _ {right}"


def _instances(text: str, base: list[tuple[int, str, int]]) -> list[dict]:
    out = []

    def add(start: int, end: int, kind: str | None) -> None:
        token = text[start:end]
        out.append({"start": start, "end": end, "kind": kind, "token": token[:200].lower(), "shape": _shape(token), "patterns": list(_context(text, start, end))})

    for s, kind, e in base:
        add(s, e, kind)
    taken, done, k = sorted((s, e) for s, _, e in base), 0, 0
    mark = _MARK.search(text)
    while mark:
        i = mark.start()
        low = max(text.rfind(c, done, i) for c in " \n\t\r") + 1
        low = max(low, done)
        stop = _SPACE.search(text, i)
        high = stop.start() if stop else len(text)
        done = high
        while k < len(taken) and taken[k][1] <= low:
            k += 1
        start = low + len(text[low:high]) - len(text[low:high].lstrip(_EDGE))
        end = low + len(text[low:high].rstrip(_EDGE))
        if not (k < len(taken) and taken[k][0] < high) and 4 <= end - start:
            add(start, end, None)
        mark = _MARK.search(text, high)
    return out


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``pii``: array of instances (start, end, kind or null, token, shape, patterns) of the whole text."""

    @F.pandas_udf("array<struct<start:int,end:int,kind:string,token:string,shape:int,patterns:array<string>>>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([_instances(t, base_spans(t)) for t in (t or "" for t in texts)], dtype=object)

    text_batches(df.sparkSession)
    return df.withColumn("pii", run(F.col(text)))


def _scores(edges: DataFrame, learned: DataFrame | None) -> DataFrame:
    """Confident patterns: (pattern, kind, confidence)."""
    if learned is not None:
        edges = edges.join(learned, "token", "left")
        kind, weight = F.coalesce("kind", "learned_kind"), F.when(F.col("kind").isNotNull(), 1.0).otherwise(F.col("learned_confidence"))
    else:
        kind, weight = F.col("kind"), F.lit(1.0)
    by_kind = edges.groupBy("pattern").agg(
        F.count("*").alias("all"), *[F.sum(F.when(kind == k, weight).otherwise(0.0)).alias(k) for k in KINDS],
    )
    best = F.greatest(*KINDS)
    return by_kind.where((best >= MIN_SUPPORT) & (best / F.col("all") >= MIN_CONFIDENCE)).select(
        "pattern", F.coalesce(*[F.when(F.col(k) == best, F.lit(k)) for k in KINDS]).alias("pattern_kind"), (best / F.col("all")).alias("confidence"),
    )


def _fits(kind: Column, shape: Column) -> Column:
    return F.coalesce(*[F.when(kind == k, shape.bitwiseAND(1 << i) > 0) for i, k in enumerate(KINDS)])


def find(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, ``base`` and ``found``: arrays of (start, rank of the kind, end, kind).

    The first pass over the texts is written once; everything after it works on the instances, a small part of the input.
    """
    rows = scan(df.select(id_column, text), text).select(F.monotonically_increasing_id().alias("row"), id_column, "pii")
    rows = written(rows, "pii")
    one = rows.select("row", F.explode("pii").alias("i")).select("row", "i.*")
    edges = written(
        one.select("token", "kind", "shape", F.explode("patterns").alias("pattern")).distinct(), "pii-edges",
    )
    patterns = written(_scores(edges, None), "pii-patterns")
    for _ in range(ROUNDS - 1):
        learned = (
            edges.where("kind IS NULL AND shape > 0").join(patterns, "pattern").where(_fits(F.col("pattern_kind"), F.col("shape")))
            .groupBy("token").agg(F.max(F.struct("confidence", "pattern_kind")).alias("m"))
            .select("token", F.col("m.pattern_kind").alias("learned_kind"), F.col("m.confidence").alias("learned_confidence"))
        )
        patterns = written(_scores(edges, learned), "pii-patterns")
    rank = lambda k: F.coalesce(*[F.when(k == x, F.lit(i)) for i, x in enumerate(KINDS)])
    found = (
        one.where("kind IS NULL AND shape > 0").select("row", "start", "end", "shape", F.explode("patterns").alias("pattern"))
        .join(patterns, "pattern").where(_fits(F.col("pattern_kind"), F.col("shape")))
        .groupBy("row", "start", "end").agg(F.max(F.struct("confidence", "pattern_kind")).alias("m"))
        .groupBy("row").agg(F.collect_list(F.struct("start", rank(F.col("m.pattern_kind")).alias("rank"), "end", F.col("m.pattern_kind").alias("kind"))).alias("found"))
    )
    base = F.transform(
        F.filter("pii", lambda i: i["kind"].isNotNull()),
        lambda i: F.struct(i["start"].alias("start"), rank(i["kind"]).alias("rank"), i["end"].alias("end"), i["kind"].alias("kind")),
    )
    return rows.select("row", id_column, F.array_sort(base).alias("base")).join(found, "row", "left").select(
        id_column, "base", F.coalesce("found", F.expr("array()").cast("array<struct<start:int,rank:int,end:int,kind:string>>")).alias("found"),
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
