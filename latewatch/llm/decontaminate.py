"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of template tokens: words in lower case without outer punctuation; numbers, units after a number and
names (capitalised words inside a sentence) become typed placeholders whose words are kept as slot values. A capitalised word that opens a
text or a sentence may be a name or not: pairs that do not leak where it is a word are counted again under both readings. A benchmark item
leaks into a document where windows of ``WINDOW`` template tokens agree. Matching windows on one diagonal (place in the
document minus place in the item) must have consistent slots: equal values of the item meet equal values of the document, so a
question with other numbers or names is caught, and chance agreement of placeholders is not; windows with few words of their own need equal
slots. Where one value of the item meets several on a diagonal, the one in most windows counts (of as many the item's own), and only windows
that contradict it are dropped, never those with the item's own slots. A pair is reported if at least ``COVER`` of the item's windows match.

Everything is built-in functions. Documents are cut into seeds of ``SEED`` tokens at every ``STRIDE``-th place, items at every place: any
``WINDOW`` equal tokens hold such a seed, so the hash join of seeds misses nothing and moves a fourth of the windows. Only documents
with a seed hit are windowed in full. Tables of the benchmark and of hits are broadcast only if they are
measured to be small, and joined by a shuffle otherwise.

Items of fewer than ``WINDOW`` tokens are not told from chance and never reported. Null and empty texts have no tokens. Rows with equal
id and text are the same document; null ids are allowed. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch.llm.common import small, written

WINDOW = 8
SEED = 5
STRIDE = 4
COVER = 0.3
OWN_WORDS = 3  # a window with fewer words that are not placeholders needs equal slots
UNITS = (
    "mm cm m km in ft mi g kg t lb oz ml l s sec min h hr hrs hour hours minute minutes second seconds day days week weeks month months year years "
    "km/h mph w kw kwh v a hz percent degrees celsius usd eur gbp dollars dollar euro euros cents cent miles mile meters metres meter metre inches inch "
    "feet foot pounds grams kilograms liters litres"
).split()
NUM, UNIT, NAME = "<num>", "<unit>", "<name>"
_NUMBER = r"^[0-9][0-9.,]*%?$"
# characters that are cut off at both ends of a word
OUTER = ".,;:!?()[]{}<>\"'`*#$&|_-+=/\\~^@\u2026\u2013\u2014\u00ab\u00bb\u201c\u201d\u201e\u2018\u2019\u00bf\u00a1"


def _small_letter(w: Column) -> Column:
    """Starts with a to z; a comparison of bytes, which costs less than cutting the letter off."""
    return (w >= "a") & (w < "{")


def tokens(text: Column) -> Column:
    """Array of (c: template token, r: word, o: template token if capitalised words that open a sentence are names too, NULL if that is the same) of a
    text."""
    words = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")

    def of(raw: Column) -> Column:
        # most words start and end with a small letter, and have nothing to cut off
        bare = lambda w: _small_letter(w) & F.substring(w, -1, 1).between("a", "z")
        cores = F.transform(raw, lambda w: F.when(bare(w), w).otherwise(F.btrim(w, F.lit(OUTER))))
        return F.transform(F.array(cores), lambda core: typed(raw, core))[0]

    def typed(raw: Column, cores: Column) -> Column:
        # cheap tests of the first letter stand before the patterns: most words are plain ones
        def one(core: Column, i: Column) -> Column:
            first, before, last = F.substring(core, 1, 1), F.get(raw, i - 1), F.get(cores, i - 1)
            large = F.lower(first) != first
            unit = (last >= "0") & (last < ":") & last.rlike(_NUMBER) & F.lower(core).isin(UNITS)
            word = F.when(unit, F.lit(UNIT)).otherwise(F.lower(core))
            kind = (
                F.when(_small_letter(core), word)
                .when((core >= "0") & (core < ":") & core.rlike(_NUMBER), F.lit(NUM))
                .when(large & (i > 0) & ~before.rlike(r"^$|[.!?:]$"), F.lit(NAME))
                .otherwise(word)
            )
            return F.struct(kind.alias("c"), core.alias("r"), F.when(~_small_letter(core) & large & ((i == 0) | before.rlike(r"^$|[.!?:]$")), F.lit(NAME)).alias("o"))

        return F.filter(F.transform(cores, one), lambda x: x["c"] != "")

    return F.transform(F.array(words), of)[0]


def _places(n: Column, size: int, step: int) -> Column:
    """1, 1 + step, ... as long as a window of ``size`` fits into ``n``."""
    none = F.slice(F.array(F.lit(1)), 1, 0)
    return F.when(n < size, none).otherwise(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)), F.lit(step)))


def _seeds(text: Column, step: int) -> Column:
    """Hashes of the seeds at every ``step``-th place, and of those that a second reading changes, under both readings."""

    def of(t: Column) -> Column:
        # places of words with a second reading; few words have one
        other = F.filter(F.transform(t, lambda x, j: F.when(x["o"].isNotNull(), j + 1)), lambda j: j.isNotNull())
        readings = F.struct(F.transform(t, lambda x: x["c"]).alias("c"), F.transform(t, lambda x: F.coalesce(x["o"], x["c"])).alias("o"), other.alias("j"))
        return F.transform(F.array(readings), hashed)[0]

    def hashed(a: Column) -> Column:
        n = F.size(a["c"])
        last = n - SEED + 1
        # the seeds that hold word j start at j - SEED + 1 to j, on the grid of 1, 1 + step, ...
        least = lambda j: F.greatest(F.ceil((j - SEED) / step), F.lit(0)).cast("int") * step + 1
        most = lambda j: (F.floor((F.least(j, last) - 1) / step) * step + 1).cast("int")
        none = F.slice(F.array(F.lit(1)), 1, 0)
        held = F.transform(a["j"], lambda j: F.when((last >= 1) & (least(j) <= most(j)), F.sequence(least(j), F.greatest(most(j), least(j)), F.lit(step))).otherwise(none))
        at = lambda p, c: F.transform(p, lambda i: F.xxhash64(F.slice(c, i, SEED)))
        return F.concat(at(_places(n, SEED, step), a["c"]), at(F.array_distinct(F.flatten(held)), a["o"]))

    return F.transform(F.array(tokens(text)), of)[0]


def _windows(text: Column) -> Column:
    def of(t: Column) -> Column:
        def one(i: Column) -> Column:
            return F.transform(F.array(F.slice(t, i, WINDOW)), lambda part: readings(i, part))[0]

        return F.flatten(F.transform(_places(F.size(t), WINDOW, 1), one))

    def readings(i: Column, part: Column) -> Column:
        differ = F.exists(part, lambda x: x["o"].isNotNull())
        return F.when(differ, F.array(read(i, part, "c"), read(i, part, "o"))).otherwise(F.array(read(i, part, "c")))

    def read(i: Column, part: Column, how: str) -> Column:
        kind = (lambda x: x["c"]) if how == "c" else (lambda x: F.coalesce(x["o"], x["c"]))
        slots = F.transform(F.filter(part, lambda x: kind(x).isin(NUM, UNIT, NAME)), lambda x: F.concat_ws(" ", kind(x), F.lower(x["r"])))
        return F.struct(i.alias("at"), F.array_join(F.transform(part, kind), " ").alias("template"), slots.alias("slots"), F.lit(how == "o").alias("open"))

    return F.transform(F.array(tokens(text)), of)[0]


def _join_key(template: Column, slots: Column) -> Column:
    """What two windows must share: the template, and the slots, too, where it has few words of its own. Rows of numbers meet equal rows only."""
    return F.when(F.size(slots) > WINDOW - OWN_WORDS, F.concat_ws("|", template, F.array_join(slots, "|"))).otherwise(template)


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """One row per (document, item) that leaks: id, ``text_key`` (hash of the text), item id, ``n_windows``, ``n_matched``, ``changed`` (some slot
    has another value than in the item)."""
    docs = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("k"))
    items = items.select(F.col(item_id).alias("b"), F.col(text).alias("t")).distinct()
    item_windows = written(
        items.select("b", _windows(F.col("t")).alias("w")).select("b", F.array_max(F.col("w.at")).cast("long").alias("n"), F.explode("w").alias("w"))
        .select("b", "n", F.col("w.at").alias("item_at"), _join_key(F.col("w.template"), F.col("w.slots")).alias("key"), F.col("w.slots").alias("item_slots"), F.col("w.open").alias("item_open")),
        "benchmark-windows",
    )
    item_seeds = written(
        items.where(F.size(tokens(F.col("t"))) >= WINDOW).select(F.explode(_seeds(F.col("t"), 1)).alias("seed")).distinct(), "benchmark-seeds",
    )
    hits = written(
        docs.select("d", "k", F.explode(_seeds(F.col("t"), STRIDE)).alias("seed")).join(small(item_seeds), "seed", "left_semi").select("d", "k").distinct(),
        "seed-hits",
    )
    found = docs.join(small(hits).select(F.col("d").alias("hd"), F.col("k").alias("hk")), F.col("d").eqNullSafe(F.col("hd")) & (F.col("k") == F.col("hk")), "left_semi")
    matched = written(
        found.distinct().select("d", "k", F.explode(_windows(F.col("t"))).alias("w")).select("d", "k", "w.*")
        .withColumn("key", _join_key(F.col("template"), F.col("slots"))).join(small(item_windows), "key")
        .select("d", "k", "b", "n", "item_at", (F.col("at") - F.col("item_at")).alias("diagonal"), "slots", "item_slots", (F.col("open") | F.col("item_open")).alias("open")),
        "matched-windows",
    )
    stated = _counted(matched.where("NOT open")).withColumn("open", F.lit(False))
    both = _counted(matched).withColumn("open", F.lit(True))
    out = stated.unionByName(both).groupBy("d", "k", "b", "n").agg(F.min(F.struct("open", "n_matched", "changed")).alias("m"))
    return out.select(
        F.col("d").alias(doc_id), F.col("k").alias("text_key"), F.col("b").alias(item_id), F.col("n").alias("n_windows"), "m.n_matched", "m.changed",
    )


def _counted(matched: DataFrame) -> DataFrame:
    """The pairs of which enough windows match with consistent slots: d, k, b, n, n_matched, changed."""
    diagonal = ["d", "k", "b", "diagonal"]
    pairs = matched.select(*diagonal, "item_at", F.explode(F.arrays_zip("item_slots", "slots")).alias("s")).select(*diagonal, "item_at", "s.*").distinct()
    votes = pairs.groupBy(*diagonal, "item_slots", "slots").agg(F.count("*").alias("c"))
    most = votes.groupBy(*diagonal, "item_slots").agg(
        F.count("*").alias("values"), F.max(F.struct("c", (F.col("slots") == F.col("item_slots")).alias("same"), "slots")).alias("m"),
    ).where("values > 1")
    torn = most.groupBy(*diagonal).agg(F.map_from_entries(F.collect_list(F.struct("item_slots", "m.slots"))).alias("most")).select(
        F.col("d").alias("td"), F.col("k").alias("tk"), F.col("b").alias("tb"), F.col("diagonal").alias("tg"), "most",
    )
    fits = F.forall(F.arrays_zip("item_slots", "slots"), lambda s: F.coalesce(F.col("most")[s["item_slots"]] == s["slots"], F.lit(True)))
    whole = matched.join(
        torn, F.col("d").eqNullSafe(F.col("td")) & (F.col("k") == F.col("tk")) & F.col("b").eqNullSafe(F.col("tb")) & (F.col("diagonal") == F.col("tg")), "left",
    ).where(F.col("most").isNull() | (F.col("slots") == F.col("item_slots")) | fits)
    out = whole.groupBy("d", "k", "b", "n").agg(F.countDistinct("item_at").alias("n_matched"), F.bool_or(F.col("slots") != F.col("item_slots")).alias("changed"))
    return out.where(F.col("n_matched") >= COVER * F.col("n"))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, with their columns."""
    bad = leaks(docs, items).select(F.col("doc_id").alias("_leak_id"), F.col("text_key").alias("_leak_key")).distinct()
    bad = small(written(bad, "leaks"))
    same = docs["doc_id"].eqNullSafe(bad["_leak_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == bad["_leak_key"])
    return docs.join(bad, same, "left_anti")


_SQL_TOKENS = r"""
    SELECT id, list_filter(list_transform(core, lambda w, i: struct_pack(c := CASE
        WHEN regexp_matches(w, '{number}') THEN '<num>'
        WHEN lower(substr(w, 1, 1)) <> substr(w, 1, 1) AND i > 1 AND NOT regexp_matches(raw[i - 1], '^$|[.!?:]$') THEN '<name>'
        WHEN lower(w) IN ({units}) AND i > 1 AND regexp_matches(core[i - 1], '{number}') THEN '<unit>'
        ELSE lower(w) END, r := w)), lambda x: x.c <> '') AS t
    FROM (SELECT id, raw, list_transform(raw, lambda w: trim(w, '{outer}')) AS core
        FROM (SELECT DISTINCT {id} AS id, regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') AS raw FROM {table}))
"""


def _sql_windows(table: str, id_column: str) -> str:
    units = ", ".join(f"'{u}'" for u in UNITS)
    toks = _SQL_TOKENS.format(table=table, id=id_column, units=units, number=_NUMBER, outer=OUTER.replace("'", "''"))
    return f"""
    SELECT id, pos, array_to_string(list_transform(t[pos:pos + {WINDOW - 1}], lambda x: x.c), ' ') AS template,
        list_transform(list_filter(t[pos:pos + {WINDOW - 1}], lambda x: x.c IN ('<num>', '<unit>', '<name>')), lambda x: x.c || ' ' || lower(x.r)) AS slots
    FROM (SELECT id, t, unnest(range(1, len(t) - {WINDOW - 2})) AS pos FROM ({toks}))
    """


SQL = f"""
WITH dw AS ({_sql_windows("documents", "doc_id")}), bw AS ({_sql_windows("benchmark", "item_id")}),
n AS (SELECT id, count(*) AS n FROM bw GROUP BY id),
m AS (
    SELECT dw.id AS d, bw.id AS b, bw.pos AS item_at, dw.pos - bw.pos AS diagonal, dw.slots AS s, bw.slots AS i FROM dw JOIN bw USING (template)
    WHERE len(dw.slots) <= {WINDOW - OWN_WORDS} OR dw.slots = bw.slots
),
p AS (SELECT DISTINCT d, b, diagonal, i[j] AS iv, s[j] AS sv FROM (SELECT *, unnest(range(1, len(i) + 1)) AS j FROM m)),
torn AS (SELECT DISTINCT d, b, diagonal FROM (SELECT d, b, diagonal, iv FROM p GROUP BY ALL HAVING count(*) > 1))
SELECT d AS doc_id, b AS item_id, n AS n_windows, count(DISTINCT item_at) AS n_matched, bool_or(s <> i) AS changed
FROM m ANTI JOIN torn USING (d, b, diagonal) JOIN n ON n.id = b GROUP BY d, b, n HAVING count(DISTINCT item_at) >= {COVER} * n
"""
