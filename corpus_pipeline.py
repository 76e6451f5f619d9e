"""From raw documents to token ids: the stages of a training corpus, each over all that the one before it kept.

``run`` writes what a stage returns as Parquet in the shared folder and reads it back as the next stage's documents. All but the last stage
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch.llm import bpe, decontaminate, line_dedup, near_dedup, quality
from latewatch.llm.common import table, written
from latewatch.llm.queries import RANK_FILE


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels`` outside of the held-out fold, does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; of chunks of lines that repeat across them the first stays."""
    return line_dedup.without_repeats(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of at least 0.8)."""
    return near_dedup.keep_one(docs, size=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no item of ``benchmark`` leaks."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the packed token ids, their number, and a hash of what they decode to."""
    out = bpe.round_trip(docs.select("doc_id", "text"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    return out.select("doc_id", F.col("bpe.n_tokens").alias("n_tokens"), F.col("bpe.ids").alias("ids"), F.sha2("bpe.decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", quality_classifier), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination), ("bpe", bpe_encoding),
]

# A trained model decides in the first stage, which SQL cannot express; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
