"""Line de-duplication by content-defined chunks of lines.

A chunk of lines ends where the rolling hash over the hashes of the last ``ROLL`` lines is 0 modulo ``DIVISOR``, so boundaries follow
the content and are found again wherever a passage is moved to; a line of more than ``LONG`` words is a chunk of its own. Chunks of
several lines and at least ``LEAST`` words, and long lines, are compared over all documents: a 64-bit hash is counted first (only hashes are
shuffled), the bytes of chunks with a repeated hash are compared, and of equal chunks the one in the smallest document (by id, then hash
of the text, then place) stays and the others are removed. Other lines stay as they are, repeated or not.

Everything is built-in functions. Null texts stay null, empty ones empty; a text all of whose chunks are repeated becomes empty, its
row stays. Rows with equal id and text are the same document: neither counts as a repetition of the other, both get the same result. Null
ids come first in the order. Empty tables give empty results; other columns stay, and ``n_chars`` follows the text where it exists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch.llm.common import small, written

ROLL = 2
DIVISOR = 3
LONG = 50
LEAST = 10


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def chunks(text: Column) -> Column:
    """Array of (no, first, last, n_words, chunk): the chunks of a text, lines counted from 1."""

    def of_lines(lines: Column) -> Column:
        hashes = F.transform(lines, _line_hash)
        words = F.transform(lines, lambda x: F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")))
        return F.transform(F.array(F.struct(hashes.alias("h"), words.alias("w"))), lambda a: of_hashes(lines, a["h"], a["w"]))[0]

    def of_hashes(lines: Column, h: Column, w: Column) -> Column:
        def ends(i: Column) -> Column:
            roll = F.coalesce(F.get(h, i - 2), F.lit(0).cast("long")) * 31 + F.get(h, i - 1)
            return (i == F.size(lines)) | (F.pmod(roll, F.lit(DIVISOR)) == 0) | (F.get(w, i - 1) > LONG) | F.coalesce(F.get(w, i) > LONG, F.lit(False))

        borders = F.filter(F.sequence(F.lit(1), F.size(lines)), ends)

        def cut(b: Column) -> Column:
            def one(last: Column, k: Column) -> Column:
                first = F.coalesce(F.get(b, k - 1), F.lit(0)) + 1
                n_words = F.aggregate(F.slice(w, first, last - first + 1), F.lit(0), lambda x, y: x + y)
                return F.struct(k.alias("no"), first.alias("first"), last.alias("last"), n_words.alias("n_words"))

            return F.transform(b, one)

        return F.transform(F.array(borders), cut)[0]

    def with_text(lines: Column) -> Column:
        join = lambda c: F.array_join(F.slice(lines, c["first"], c["last"] - c["first"] + 1), "\n")
        return F.transform(of_lines(lines), lambda c: F.struct(c["no"].alias("no"), c["first"].alias("first"), c["last"].alias("last"), c["n_words"].alias("n_words"), join(c).alias("chunk")))

    return F.transform(F.array(F.split(F.coalesce(text, F.lit("")), "\n", -1)), with_text)[0]


def _removable(c: Column) -> Column:
    return (c["n_words"] > LONG) | ((c["last"] > c["first"]) & (c["n_words"] >= LEAST))


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks to remove: one row per document that has some, with ``d`` (id), ``k`` (hash of the text) and ``gone`` (numbers of chunks)."""
    named = docs.select(F.col(doc_id).alias("d"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("k"), F.col(text).alias("t"))
    rows = named.select("d", "k", F.explode(F.filter(chunks(F.col("t")), _removable)).alias("c")).select(
        "d", "k", F.col("c.no").alias("no"), F.col("c.chunk").alias("chunk"), F.xxhash64("c.chunk").alias("h"),
    )
    counted = written(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated-hashes")
    repeated = written(rows.join(small(counted), "h", "left_semi"), "repeated-chunks")
    first = repeated.groupBy("h", "chunk").agg(F.min(F.struct("d", "k", "no")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = repeated.join(first, ["h", "chunk"]).where(~F.struct("d", "k", "no").eqNullSafe(F.col("first")))
    return written(later.groupBy("d", "k").agg(F.collect_set("no").alias("gone")), "removed-chunks")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated chunks taken out of ``text``, and ``_gone`` (numbers of the removed chunks)."""
    gone = small(removed(docs, doc_id, text), F.size("gone")).withColumnsRenamed({"d": "_gone_id", "k": "_gone_key", "gone": "_gone"})
    same = docs[doc_id].eqNullSafe(F.col("_gone_id")) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == F.col("_gone_key"))
    left = F.array_join(
        F.transform(F.filter(chunks(F.col(text)), lambda c: ~F.array_contains("_gone", c["no"])), lambda c: c["chunk"]), "\n",
    )
    out = docs.join(gone, same, "left")
    return out.withColumns({text: F.when(F.col("_gone").isNull(), F.col(text)).otherwise(left)}).drop("_gone_id", "_gone_key")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the columns they have, repeated chunks taken out of ``text``."""
    out = dedup(docs)
    return (out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out).select(*[F.col(f"`{c}`") for c in docs.columns])


SQL = rf"""
WITH l AS (
    SELECT doc_id, i, line, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h, len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS w
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)
), b AS (
    SELECT *, (coalesce(lag(h) OVER o, 0) * 31 + h) % {DIVISOR} = 0 OR w > {LONG} OR coalesce(lead(w) OVER o, 0) > {LONG} AS ends FROM l WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), n AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no FROM b),
c AS (SELECT doc_id, no, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS lines, sum(w) AS words FROM n GROUP BY doc_id, no),
f AS (
    SELECT *, (words > {LONG} OR (lines > 1 AND words >= {LEAST})) AND row_number() OVER (PARTITION BY chunk, words > {LONG} OR (lines > 1 AND words >= {LEAST}) ORDER BY doc_id, no) > 1 AS gone
    FROM c
)
SELECT doc_id, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed, length(coalesce(string_agg(chunk, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS n_chars,
    sha256(coalesce(string_agg(chunk, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS text_sha256
FROM f GROUP BY doc_id
"""
