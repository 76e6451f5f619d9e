"""Quality rules: document statistics as Spark expressions, and a decision list learned from labelled statistics.

``with_statistics`` computes everything with built-in functions on one row at a time, so no text moves. ``learn`` is
sequential covering: a rule for bad documents is grown literal by literal (threshold on one statistic) by information gain,
pruned from its end on rows kept apart, and accepted if it is precise there; what it covers is taken out, and the next
rule is grown. ``verdict`` turns the ordered list into one conditional expression.

The list is learned on the driver from at most ``SAMPLE`` labelled rows (smallest hash of the id first); statistics and
verdicts cover all rows. Null and empty texts have no words. Null labels and ids do not train; without labelled rows the list is empty and
only the base rules reject. Windows of eight words are compared by 64-bit hashes. Repeated rows give equal results; other
columns stay as they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch.llm.common import hash_sample

SAMPLE = 20_000
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
NEARLY = 0.9
SPACE = r"[\x20\x09-\x0D]+"

STATISTICS = ["n_words", "mean_word", "symbol_share", "upper_share", "bang_share", "duplicate_line_share", "repeat_share", "distinct_share", "words_per_line"]


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that are found at least twice in the text."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            return F.array_sort(F.transform(F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"))
        return F.aggregate(_let(ordered, places), start, step, lambda a: a["n"])

    with_windows = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(with_windows)


def with_statistics(df: DataFrame, text: str = "text", out: str = "statistics") -> DataFrame:
    """``df`` with ``out``: struct of counts (long)."""
    t = F.coalesce(F.col(text), F.lit(""))
    count = lambda pattern: F.regexp_count(t, F.lit(pattern)).cast("long")

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"), _repeat_words(w).alias("n_repeat_words"),
        )

    words = F.filter(F.split(t, SPACE), lambda w: w != "")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    parts = F.struct(
        _let(words, of_words).alias("w"),
        _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
        count(r"[#*$%&|<>]").alias("n_symbols"), count(r"[!?]").alias("n_bang"),
        (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
    )
    return df.withColumn(out, parts).withColumn(out, F.struct(f"{out}.w.*", f"{out}.l.*", f"{out}.n_symbols", f"{out}.n_bang", f"{out}.n_upper"))


def shares(s: str = "statistics") -> list[Column]:
    """The columns that rules speak of, from the counts."""
    c = lambda name: F.col(f"{s}.{name}")
    per = lambda a, b: F.coalesce(F.try_divide(c(a), c(b)), F.lit(0.0)).cast("double")
    columns = [
        c("n_words").cast("double"), per("word_chars", "n_words"), per("n_symbols", "word_chars"), per("n_upper", "word_chars"), per("n_bang", "n_words"),
        per("n_dup_lines", "n_lines"), per("n_repeat_words", "n_words"), per("n_distinct", "n_words"), per("n_words", "n_lines"),
    ]
    return [x.alias(n) for x, n in zip(columns, STATISTICS, strict=True)]


@dataclass(frozen=True)
class Literal:
    statistic: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.statistic) > self.cut if self.above else F.col(self.statistic) <= self.cut

    def holds(self, value: float) -> bool:
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.cut:g}"


Rule = tuple[Literal, ...]


def learn(
    rows: list[tuple[tuple[float, ...], int]], cuts: int = 24, longest: int = 3, most_rules: int = 16, precision: float = 0.95, least: int = 4,
) -> list[Rule]:
    """Ordered rules for rows labelled 0 (bad); the rest is kept. Every third row is for pruning. Sets of rows are bits of integers."""
    if not rows:
        return []
    bad, good = _bits([r[1] == 0 for r in rows]), _bits([r[1] == 1 for r in rows])
    test = _bits([k % 3 == 2 for k in range(len(rows))])
    literals: list[tuple[Literal, int]] = []
    for f, name in enumerate(STATISTICS):
        values = sorted(r[0][f] for r in rows)
        tails = sorted(r[0][f] for r in rows if r[1] == 0)
        after = dict(pairwise(sorted(set(values))))  # a cut lies half-way to the next value
        at = {v[len(v) * k // cuts] for v in (values, tails) if v for k in range(1, cuts)}
        points = {float(f"{(v + after.get(v, v)) / 2:.4g}") for v in at}
        for cut in sorted(points):
            over = _bits([r[0][f] > cut for r in rows])
            literals += [(Literal(name, True, cut), over), (Literal(name, False, cut), ((1 << len(rows)) - 1) & ~over)]
    grow = ~test
    out: list[Rule] = []
    left = bad | good
    while len(out) < most_rules and (left & bad).bit_count() >= least:
        rule, held = [], left
        while len(rule) < longest and held & good & grow:
            p0, n0 = (held & bad & grow).bit_count(), (held & good & grow).bit_count()
            base = math.log2(p0 / (p0 + n0)) if p0 else 0.0
            gains = []
            for lit, rows_of in literals:
                p = (held & rows_of & bad & grow).bit_count()
                if p:
                    n = (held & rows_of & good & grow).bit_count()
                    gains.append((p * (math.log2(p / (p + n)) - base), lit, rows_of))
            top, like, _ = max(gains, key=lambda g: g[0], default=(0.0, None, 0))
            if top <= 1e-9:
                break
            # of cuts about as good, the strictest: what lies between the classes is not rejected
            near = [g for g in gains if g[0] >= NEARLY * top and (g[1].statistic, g[1].above) == (like.statistic, like.above)]
            _, lit, rows_of = max(near, key=lambda g: g[1].cut if like.above else -g[1].cut)
            rule.append((lit, rows_of))
            held &= rows_of
        if not rule:
            break

        def cover(k: int, rule=rule) -> int:
            held = left
            for _, rows_of in rule[:k]:
                held &= rows_of
            return held

        def worth(k: int) -> tuple[float, int]:
            p, n = (cover(k) & bad & test).bit_count(), (cover(k) & good & test).bit_count()
            return ((p - n) / (p + n) if p + n else -1.0, -k)

        k = -max(worth(k) for k in range(1, len(rule) + 1))[1]
        held = cover(k)
        p, n = (held & bad).bit_count(), (held & good).bit_count()
        pt, nt = (held & bad & test).bit_count(), (held & good & test).bit_count()
        if p < least or p < precision * (p + n) or pt < precision * (pt + nt):
            break
        out.append(tuple(lit for lit, _ in rule[:k]))
        left &= ~held
    return out


def _bits(flags: list[bool]) -> int:
    return int("".join("1" if f else "0" for f in reversed(flags)) or "0", 2)


def verdict(rules: list[Rule]) -> Column:
    """True: keep. One conditional expression, the rules in their order."""
    out = None
    for rule in rules:
        condition = rule[0].column()
        for lit in rule[1:]:
            condition = condition & lit.column()
        out = F.when(condition, False) if out is None else out.when(condition, False)
    return F.lit(True) if out is None else out.otherwise(True)


def base_failed(s: str = "statistics") -> Column:
    c = lambda name: F.col(f"{s}.{name}")
    return (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words"))


def train(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """``stats``: doc_id and ``statistics``; ``labels``: doc_id and quality."""
    known = labels.where("quality IN (0, 1)").select(F.col("doc_id").alias("_id"), F.col("quality").alias("_y"))
    rows = hash_sample(stats.join(known, F.col("doc_id") == F.col("_id")).select("_id", "_y", *shares()), "_id", sample, "_y", *STATISTICS)
    return learn([(tuple(r[s] for s in STATISTICS), r["_y"]) for r in rows])
