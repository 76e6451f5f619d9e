"""Secrets: fixed base patterns, and weak candidates linked when complementary parts stand close together.

Everything is built-in functions. Places of matches come from the lengths of the matches and of the gaps between them.
Besides the base kinds a text is scanned for weak parts: identifiers, secret-like words and endpoints. One part alone says
little; a weak part is reported only if a complementary part (base spans count as parts, too) lies within its scope,
``SCOPE`` code points before or after it. This interval join needs no pairs: with the parts of a text in order, the
nearest end before and the nearest start after, by kind, are running extremes over a window.

Null and empty texts have no spans. Rows with equal id and text are the same document and get the same result, each its own
row; null ids are allowed. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latewatch.llm.common import written

KINDS = ("assign", "access", "hex")  # in the order of the contract; (pattern, group whose length counts, least length)
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
# Weak parts. Possessive repetition keeps the time linear in the text.
_WORD = "[A-Za-z0-9+/_-]"
WEAK = {
    "weak_id": (r"""(?i:\b(?:client_?id|key_?id|user(?:_?name)?|account|login|tenant))["']?\x20{0,9}[:=]\x20{0,9}["']?[A-Za-z0-9._@-]{3,}+"""
                r"""|(?<![A-Za-z0-9])(?=[A-Z0-9]{16})(?=[A-Z]*+[0-9])(?=[0-9]*+[A-Z])[A-Z0-9]++(?![a-z])""", 0, 1),
    "weak_secret": (rf"(?<!{_WORD})(?={_WORD}{{20}})(?=[^0-9\s]*+[0-9])(?=[^a-z\s]*+[a-z])(?=[^A-Z\s]*+[A-Z]){_WORD}++={{0,2}}", 0, 20),
    "weak_endpoint": (r"\b(?:https?|ftps?|jdbc:[a-z]{2,20}|postgres(?:ql)?|mysql|redis|mongodb|amqps?|ldaps?|s3)://[^\s\"'<>]{3,}+"
                      r"|\b[a-z0-9-]{1,63}(?:\.[a-z0-9-]{1,63}){1,9}:[0-9]{2,5}\b", 0, 1),
}
PART = {"assign": "secret", "hex": "secret", "access": "id", "weak_id": "id", "weak_secret": "secret", "weak_endpoint": "endpoint"}
COMPLEMENTS = {"id": ("secret",), "secret": ("id", "endpoint"), "endpoint": ("secret",)}
SCOPE = 160
PART_SIZE = 256  # matches whose places are counted together
_RANK = {k: i for i, k in enumerate([*KINDS, *WEAK])}


def places(text: Column, kind: str) -> Column:
    """Spans of one kind: array of (start, rank, end, kind), non-overlapping from the left; short matches are dropped."""
    pattern, group, least = (BASE | WEAK)[kind]
    span = F.struct(F.lit(0).alias("start"), F.lit(0).alias("rank"), F.lit(0).alias("end"), F.lit("").alias("kind"))
    # hex digits are everywhere: only runs that can count are looked for, which are whole runs all the same
    pattern = "[0-9a-f]{24,}+" if kind == "hex" else pattern
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.length(m))
    counted = sizes if group == 0 else F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda m: F.length(m))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    steps = F.arrays_zip(sizes.alias("size"), counted.alias("counted"), F.slice(gaps, 1, F.size(sizes)).alias("gap"))
    none = F.slice(F.array(span), 1, 0)
    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(a: Column, s: Column) -> Column:
        start = a["at"] + s["gap"]
        one = F.struct(start.alias("start"), F.lit(_RANK[kind]).alias("rank"), (start + s["size"]).alias("end"), F.lit(kind).alias("kind"))
        return F.struct((start + s["size"]).alias("at"), F.when(s["counted"] >= least, F.concat(a["out"], F.array(one))).otherwise(a["out"]).alias("out"))

    def moved(x: Column, by: Column) -> Column:
        return F.struct((x["start"] + by).alias("start"), x["rank"].alias("rank"), (x["end"] + by).alias("end"), x["kind"].alias("kind"))

    def whole(parts: Column) -> Column:
        joined = lambda a, p: F.struct(
            (a["at"] + p["at"]).alias("at"), F.concat(a["out"], F.array(F.transform(p["out"], lambda x: moved(x, a["at"])))).alias("out"))
        return F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.slice(F.array(none), 1, 0).alias("out")), joined, lambda a: F.flatten(a["out"]))

    # an array grows by copies: places are counted from the start of every PART_SIZE matches, then moved to where that lies
    def in_parts(all_: Column) -> Column:
        cuts = F.sequence(F.lit(0), F.greatest(F.size(all_) - 1, F.lit(0)), F.lit(PART_SIZE))
        return whole(F.transform(cuts, lambda c: F.aggregate(F.slice(all_, c + 1, F.lit(PART_SIZE)), zero, step)))

    found = F.transform(F.array(steps), in_parts)[0]
    return F.when(text.rlike(pattern), found).otherwise(none)


def scan(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: id, ``key`` (hash of the text), ``base`` and ``weak`` spans."""
    t = F.coalesce(F.col(text), F.lit(""))
    every = lambda kinds: F.array_sort(F.concat(*[places(t, k) for k in kinds]))
    return df.select(F.col(id_column), F.xxhash64(t).alias("key"), every(BASE).alias("base"), every(WEAK).alias("weak"))


def link(scanned: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Weak spans with a complementary part in scope that overlap no base span: id, key, ``found``."""
    parts = (
        scanned.where(F.size("weak") > 0).select(id_column, "key", F.explode(F.concat("base", "weak")).alias("s")).distinct()
        .select(id_column, "key", "s", F.coalesce(*[F.when(F.col("s.kind") == k, F.lit(p)) for k, p in PART.items()]).alias("part"))
    )
    order = Window.partitionBy(id_column, "key").orderBy("s.start", "s.rank")
    so_far, from_here = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    close = {}
    for p in COMPLEMENTS:
        before = F.max(F.when(F.col("part") == p, F.col("s.end"))).over(so_far)
        after = F.min(F.when(F.col("part") == p, F.col("s.start"))).over(from_here)
        close[p] = F.coalesce(F.col("s.start") - before <= SCOPE, F.lit(False)) | F.coalesce(after - F.col("s.end") <= SCOPE, F.lit(False))
    # base spans that start before one, the furthest end, and after it, the nearest start
    base = lambda c: F.when(F.col("s.kind").isin(*BASE), F.col(c))
    apart = F.coalesce(F.max(base("s.end")).over(so_far) <= F.col("s.start"), F.lit(True)) & F.coalesce(F.min(base("s.start")).over(from_here) >= F.col("s.end"), F.lit(True))
    near = parts.select("*", apart.alias("apart"), *[c.alias(f"near_{p}") for p, c in close.items()])
    wanted = F.lit(False)
    for p, others in COMPLEMENTS.items():
        for o in others:
            wanted = wanted | ((F.col("part") == p) & F.col(f"near_{o}"))
    return near.where(F.col("s.kind").isin(*WEAK) & wanted & F.col("apart")).groupBy(id_column, "key").agg(F.collect_list("s").alias("found"))


def find(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, ``base`` and ``found`` spans (``found`` does not overlap ``base``). Texts are
    scanned once, where they are read; only spans are shuffled."""
    scanned = written(scan(df, id_column, text), "secrets")
    linked = link(scanned, id_column).select(F.col(id_column).alias("_id"), F.col("key").alias("_key"), "found")
    joined = scanned.join(linked, scanned[id_column].eqNullSafe(F.col("_id")) & (scanned["key"] == F.col("_key")), "left")
    return joined.select(id_column, "base", F.coalesce("found", F.slice("weak", 1, 0)).alias("found"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
