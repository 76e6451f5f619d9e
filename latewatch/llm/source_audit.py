"""How far the sources of a language diverge from each other and from their language, by exact smoothed term shares.

Terms are runs of letters A-Z (in lower case) and of code points beyond ASCII. Arrow kernels do the counting where the texts are read:
``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode`` and two hash ``group_by`` (occurrences per document and term, then
occurrences and documents per group and term) turn ``SLICE_BYTES`` of text into one table of partial counts; Spark adds these up. A language
keeps the terms of at least ``LEAST_DOCS`` of its documents. Shares are whole numbers of 1e-9, from long division in steps
of 1,000, so nothing is rounded and nothing overflows below 9e15 terms.

For the sums over pairs of sources the kept terms of a language are dealt by hash into columnar shards of about ``TERMS``, and its sources into
blocks of about ``BLOCK``. A shard with two blocks is one matrix of shares, which gives the partial sums of its pairs; these are added up, and
terms that neither source has are added by their number. A language with one block, the usual case, sends each count once. No group is
larger than such a matrix, however many rows a source or a language holds.

Null text, language and source are ''. Empty texts have no terms, but their group counts as one that occurs. Repeated rows are documents of
their own; ids are not read. Ties are ranked by item. Without kept terms all pair values are 0; a language with one source has no pairs.
An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latewatch.llm.common import fits, text_batches, written

BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 30
PRIOR = 5
TOP_TERMS = 50
SLICE_BYTES = 16_000_000
BLOCK = 500
TERMS = 1_000
COUNTS = "lang string, source string, term string, n long, docs long"


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches gathered to about ``SLICE_BYTES`` of text; one very long text is a table of its own size."""
    held, size = [], 0
    for batch in batches:
        start = 0
        for k, n in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
            size += n
            if size >= SLICE_BYTES:
                yield pa.Table.from_batches([*held, batch.slice(start, k + 1 - start)])
                held, size, start = [], 0, k + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def count_terms(rows: pa.Table) -> pa.Table:
    """(lang, source, term, n, docs) of some rows, with one row of the empty term for each group that occurs."""
    rows = rows.combine_chunks()
    lang, source = (pc.dictionary_encode(rows[c].combine_chunks()) for c in ("lang", "source"))
    n_sources = len(source.dictionary)
    group = lang.indices.to_numpy().astype(np.int64) * n_sources + source.indices.to_numpy()
    words = pc.split_pattern_regex(pc.ascii_lower(rows["text"].combine_chunks()), pattern=BETWEEN)
    doc, flat = pc.list_parent_indices(words), pc.list_flatten(words)
    real = pc.not_equal(flat, "")
    coded = pc.dictionary_encode(pc.filter(flat, real))
    n_terms = max(1, len(coded.dictionary))
    key = pc.filter(doc, real).to_numpy().astype(np.int64) * n_terms + coded.indices.to_numpy()
    per_doc = pa.table({"k": key}).group_by("k", use_threads=False).aggregate([([], "count_all")])
    doc, term = np.divmod(per_doc["k"].to_numpy(), n_terms)
    per_group = pa.table({"k": group[doc] * n_terms + term, "n": per_doc["count_all"]}).group_by("k", use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    group_of, term = np.divmod(per_group["k"].to_numpy(), n_terms)
    seen = np.unique(group)
    groups_ = np.concatenate([group_of, seen])
    none = np.zeros(len(seen), np.int64)
    terms = pa.concat_arrays([coded.dictionary.take(pa.array(term)), pa.array([""] * len(seen), coded.dictionary.type)])
    return pa.table({
        "lang": lang.dictionary.take(pa.array(groups_ // n_sources)), "source": source.dictionary.take(pa.array(groups_ % n_sources)), "term": terms,
        "n": np.concatenate([per_group["n_sum"].to_numpy(), none]), "docs": np.concatenate([per_group["n_count"].to_numpy(), none]),
    })


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs) over all rows; the empty term marks the groups that occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _tables(batches):
            yield from count_terms(rows).to_batches(max_chunksize=100_000)

    text_batches(docs.sparkSession)
    known = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((text, "text"), (lang, "lang"), (source, "source"))])
    return known.mapInArrow(run, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(1e9 * (n + PRIOR) / (total + PRIOR * v)), exactly: three digits at a time."""
    part, whole = n + PRIOR, total + PRIOR * v
    out = F.lit(0).cast("long")
    for _ in range(3):
        out = out * 1000 + F.call_function("div", part * 1000, whole)
        part = (part * 1000) % whole
    return out + 1


def _cell(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Sums of abs(p - q) over the terms that one shard holds for its two blocks of sources: (lang, one, other, value, rest), where
    ``rest`` is the same difference for a term that neither source has, and ``terms`` is how many terms were summed."""
    lang, _, low, high = (k.as_py() for k in key)
    marks = rows.filter(pc.equal(rows["term"], "")).sort_by("source")
    names, absent = marks["source"].combine_chunks(), marks["p"].to_numpy()
    counted = rows.filter(pc.not_equal(rows["term"], ""))
    terms = pc.dictionary_encode(counted["term"].combine_chunks())
    shares = np.repeat(absent[:, None], len(terms.dictionary), axis=1)
    shares[pc.index_in(counted["source"].combine_chunks(), names).to_numpy(zero_copy_only=False), terms.indices.to_numpy()] = counted["p"].to_numpy()
    block = marks["block"].to_numpy()
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    one, other, value = [], [], []
    for k, i in enumerate(left):
        others = right[k + 1 :] if low == high else right
        one.append(np.full(len(others), i))
        other.append(others)
        value.append(np.abs(shares[others] - shares[i]).sum(axis=1))
    one, other, value = (np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64) for x in (one, other, value))
    return pa.table({
        "lang": pa.array([lang] * len(one), pa.string()), "one": names.take(pa.array(one)), "other": names.take(pa.array(other)), "value": value,
        "terms": np.full(len(one), shares.shape[1]), "rest": np.abs(absent[one] - absent[other]),
    })


def _ranked(df: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (``pair``: distance to each other source; ``term``: the ``top`` terms that a source holds more of than its language),
    item, value, rank."""
    counts = written(term_counts(docs, text, lang, source), "term-counts")
    kept = written(
        counts.where("term != ''").groupBy("lang", "term").agg(F.sum("docs").alias("d"), F.sum("n").alias("lang_n")).where(F.col("d") >= least_docs).drop("d"),
        "kept-terms",
    )
    rows = written(counts.join(fits(kept), ["lang", "term"]), "kept-counts")
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    marks = counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").fillna(0, ["total"])
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    marks = written(marks, "audit-groups")
    langs = written(marks.groupBy("lang").agg(F.count("*").alias("s")).join(sizes, "lang", "left").fillna(0, ["v", "lang_total"]), "audit-langs")
    marks = written(marks.join(fits(langs), "lang"), "audit-sizes")
    shares = written(
        rows.join(fits(marks), ["lang", "source"]).select(
            "lang", "source", "term", "s", "v", share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
            share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"),
        ),
        "audit-shares",
    )
    more = _ranked(shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")), "term").where(F.col("rank") <= top)

    def dealt(df: DataFrame, shard: Column) -> DataFrame:
        blocks = F.ceil(F.col("s") / BLOCK).cast("int")
        df = df.withColumn("block", F.pmod(F.xxhash64("source"), blocks).cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), blocks - 1)))
        return df.select("lang", shard.alias("shard"), F.least("block", "x").alias("low"), F.greatest("block", "x").alias("high"), "block", "source", "term", "p")

    shards = F.greatest(F.lit(1), F.ceil(F.col("v") / TERMS)).cast("int")
    absent = F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("total"), F.greatest(F.col("v"), F.lit(1)))).otherwise(0)
    frames = marks.where("s > 1").select("lang", "source", "s", "v", F.lit("").alias("term"), absent.alias("p"))
    frames = frames.withColumn("shard", F.explode(F.sequence(F.lit(0), shards - 1)))
    cells = dealt(shares.where("s > 1"), F.pmod(F.xxhash64("term"), shards).cast("int")).unionByName(dealt(frames, F.col("shard")))
    sums = cells.groupBy("lang", "shard", "low", "high").applyInArrow(_cell, "lang string, one string, other string, value long, terms long, rest long")
    pairs = sums.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"), F.max("rest").alias("rest"))
    pairs = pairs.join(fits(langs), "lang").withColumn("value", F.col("value") + (F.col("v") - F.col("terms")) * F.col("rest"))
    both = pairs.select("lang", "value", F.explode(F.array(*[F.struct(F.col(a).alias("source"), F.col(b).alias("item")) for a, b in (("one", "other"), ("other", "one"))])).alias("x"))
    return _ranked(both.select("lang", "x.source", "x.item", "value"), "pair").unionByName(more)


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), tokens AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), counts AS (SELECT lang, source, term, count(*) AS n FROM tokens GROUP BY ALL
), kept AS (SELECT lang, term, count(*) AS n FROM tokens GROUP BY ALL HAVING count(DISTINCT d) >= 30
), langs AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM kept GROUP BY lang
), sources AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::BIGINT AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN (SELECT c.* FROM counts c JOIN kept USING (lang, term)) c USING (lang, source) GROUP BY ALL
), shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.total + 5 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS q
  FROM sources s JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce((
      SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source != b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
