"""Name lookups and set differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch.functions import short_name


def with_names(
    df: DataFrame, lookup: DataFrame, key: str, code: str = "IATA_CODE", name: str = "AIRLINE",
    out: str = "name", width: int = 25,
) -> DataFrame:
    """Add the display name of ``key``; an unknown code stands for itself.

    The lookup carries no broadcast hint: the optimizer broadcasts it when its size is under the session's limit.
    """
    names = lookup.select(F.col(code).alias("_code"), F.col(name).alias("_name"))
    joined = df.join(names, F.col(key) == F.col("_code"), "left")
    text = F.col(key).cast("string")
    return joined.withColumn(out, short_name("_name", text, width)).drop("_code", "_name")


def missing(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys that are expected but not found. Both sides are reduced to their keys first, so a hot key is one row."""
    return expected.select(key).distinct().join(found.select(key).distinct(), key, "left_anti")
