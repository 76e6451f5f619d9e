"""The dealt operators as queries over whole tables, with the digest columns of their contracts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch.llm import bpe, decontaminate, html_content, langid, line_dedup, lm, near_dedup, pii, quality, rules, secret_scan, source_audit, token_align
from latewatch.llm.common import table, written

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_content.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select(
        "doc_id", *[count(k) for k in pii.KINDS], F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
        pii.spans_text(F.concat("base", "found")).alias("spans"), F.size("found").cast("long").alias("n_found"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaks: one row per document and item."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup(docs.withColumn("n_chunks", F.size(line_dedup.chunks(F.col("text"))).cast("long")))
    text = F.coalesce("text", F.lit(""))
    return out.select(
        "doc_id", "n_chunks", F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"), F.length(text).cast("long").alias("n_chars"),
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
    )


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingles, as the contract has it; the stage of the pipeline takes five."""
    return near_dedup.find(table(spark, sf_dir, "documents"), size=2).drop("text_key")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select(
        "doc_id", *[count(k) for k in secret_scan.KINDS], F.sha2(secret_scan.spans_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.spans_text(F.concat("base", "found")).alias("spans"), F.size("found").cast("long").alias("n_linked"),
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.round_trip(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    return out.select(
        "doc_id", F.col("bpe.n_tokens").alias("n_tokens"), F.sha2("bpe.ids", 256).alias("ids_sha256"),
        F.sha2("bpe.decoded", 256).alias("decoded_sha256"),
    )


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = written(rules.with_statistics(docs).select("doc_id", "statistics"), "rules-statistics")
    learned = rules.train(stats, table(spark, sf_dir, "labels"))
    out = stats.select("*", *rules.shares()).withColumn("base_failed", rules.base_failed())
    return out.select(
        "doc_id", *[F.col(f"statistics.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed", (~F.col("base_failed") & rules.verdict(learned)).alias("kept"),
    )


def op11_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mixture``: all languages of the text with their shares, the largest first."""
    out = langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    one = lambda x: F.concat_ws(":", x["lang"], F.format_number(x["share"], 3))
    return out.select(
        "doc_id", "held_out", F.col("language.lang_pred").alias("lang_pred"), F.col("language.score").alias("score"),
        F.array_join(F.transform("language.languages", one), ",").alias("mixture"),
    )


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.compare(table(spark, sf_dir, "documents"), public_tokenizers.path(ALIGNED[0]), public_tokenizers.path(ALIGNED[1]))


QUERIES = {f.__name__: f for f in (op1_html_content, op2_pii, op3_decontaminate, op4_line_dedup, op5_lm, op6_quality, op7_near_dedup, op8_secrets, op9_bpe, op10_rules, op11_langid, op12_source_audit, op13_token_align)}
SQL: dict[str, str] = {
    "op3_decontaminate": decontaminate.SQL, "op4_line_dedup": line_dedup.SQL, "op7_near_dedup": near_dedup.SQL,
    "op12_source_audit": source_audit.SQL,
}
