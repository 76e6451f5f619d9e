"""Session, shared scratch folder, lineage cuts and size-checked lookup joins."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup side is broadcast only if its measured size is below this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# Assumed in-memory overhead of one broadcast row beyond its key text.
BROADCAST_ROW_BYTES = 64
# Copies of the lookup side in the shuffled join that serves larger tables.
JOIN_SALTS = 16


def build_session(name: str = "latewatch", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are planned for; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # join state of a day of traffic belongs on disk, not on the heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # the plans are built from many small expressions; do not look up the call site of each one
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder once; a cluster session without it is refused,
    because a machine-local folder is lost with its machine.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current is None:
        if configured is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
            configured = tempfile.mkdtemp(prefix="latewatch-")
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    return (configured or current).rstrip("/")


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder. It stays until ``clean_scratch``."""
    path = os.path.join(shared_dir(spark), "latewatch", f"{name}-{uuid.uuid4().hex}")
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clean_scratch(spark: SparkSession) -> int:
    """Remove what this application has written to scratch paths, once the frames that read it are done with. Returns how many
    paths there were. (Checkpoints of ``pin`` are removed by Spark with ``spark.cleaner.referenceTracking.cleanCheckpoints``.)"""
    context = spark.sparkContext
    paths = _SCRATCH.pop(context.applicationId, [])
    for path in paths:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage there, so a lost executor never recomputes it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    table_bytes: int,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    salts: int = JOIN_SALTS,
) -> DataFrame:
    """Left join of many rows to a unique-key table of *measured* size.

    Below the limit the table is broadcast and the rows of ``df`` never move. Above it both sides are shuffled on
    the key plus a salt that is a function of the row, which cuts a hot key into ``salts`` parts; identical copies of
    one row share a salt and are left to the adaptive skew join.
    """
    on = list(on)
    if table_bytes <= limit_bytes:
        return df.join(F.broadcast(table), on, "left")
    hashable = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return salted.join(copies, [*on, "_salt"], "left").drop("_salt")
