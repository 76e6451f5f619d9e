"""What several operators of this subpackage share: tables, written intermediate results, text in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch.runtime import scratch_path

# Texts are worked on in groups of about this many characters, so memory follows the longest text, not the batch.
GROUP_CHARS = 1_000_000
# Rows of an Arrow batch. Spark's default of 10,000 supposes short rows; with whole texts it would be hundreds of MB a worker.
BATCH_ROWS = 1_000
# Any other table is broadcast up to this many bytes, measured.
BROADCAST_BYTES = 32 * 1024 * 1024
# Tables of ids or hashes up to this many rows (tens of MB) are broadcast.
BROADCAST_ROWS = 1_000_000


def text_batches(spark: SparkSession) -> None:
    """Let this session send texts to Python workers in batches of ``BATCH_ROWS`` at most (a smaller setting stays)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored as Parquet in the shared folder and read back: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def groups(texts: list[str | None], limit: int = GROUP_CHARS) -> Iterator[list[str]]:
    """The texts in order, null as empty, cut into lists of about ``limit`` characters (one text at least)."""
    out, size = [], 0
    for t in texts:
        t = t or ""
        if out and size + len(t) > limit:
            yield out
            out, size = [], 0
        out.append(t)
        size += len(t)
    if out:
        yield out


def crc_mod(column: str, m: int):
    """crc32 of the id as text, modulo ``m``: the fixed folds of the contracts. A null id is in no held-out fold (-1)."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(m)).cast("int"), F.lit(-1))


def hash_sample(df: DataFrame, id_column: str, size: int, *ties: str) -> list:
    """At most ``size`` rows of a labelled table, those with the smallest hash of the id, collected.

    A hash limit somewhat above ``size / rows`` is applied first, so tasks send about ``size`` rows together, however many
    tasks there are; the order then cuts at exactly ``size``.
    """
    hashed = df.withColumn("_h", F.xxhash64(id_column))
    n = hashed.count()
    if n > size:
        share = min(1.0, size / n + 6 * (size / n / n) ** 0.5 + 100 / n)
        hashed = hashed.where(F.col("_h") < int(share * 2**64) - 2**63 - (share == 1.0))
    return hashed.orderBy("_h", id_column, *ties).limit(size).collect()


def small(df: DataFrame, weight=None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, marked for broadcast if it is *measured* to have at most ``limit`` rows (or sum of ``weight``, for rows that hold
    arrays); otherwise as it is, for a shuffled join. Both ways give the same rows."""
    n = df.select(F.coalesce(F.sum(weight), F.lit(0)) if weight is not None else F.count("*")).first()[0]
    return F.broadcast(df) if n <= limit else df


def fits(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A written table, marked for broadcast if the *measured* bytes of its values (texts by length, 16 for any other value and for each
    text on top, 32 for a row) are at most ``limit``; otherwise as it is, for a shuffled join. Both ways give the same rows."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    width = sum(texts, F.lit(32 + 16 * len(df.columns)).cast("long"))
    size = df.select(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= limit else df
