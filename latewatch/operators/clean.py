"""Cleaning, labelling and the cleaning funnel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch.functions import label_gt

# Columns kept for modelling, and what each cleaning variant requires.
MODEL_COLUMNS = [
    "MONTH", "DAY", "DAY_OF_WEEK", "SCHEDULED_DEPARTURE",
    "AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "DISTANCE", "SCHEDULED_TIME",
]
REQUIRED_TEMPORAL = ("SCHEDULED_TIME", "DISTANCE")
REQUIRED_RANDOM = ("SCHEDULED_TIME",)
CATEGORICAL = ("AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT")


def _steps(flags: Sequence[str], source: str, required: Sequence[str]) -> list[tuple[str, Column]]:
    operated = F.lit(True)
    for f in flags:
        operated = operated & (F.col(f) == 0)
    inputs = F.lit(True)
    for c in required:
        inputs = inputs & F.col(c).isNotNull()
    return [("operated", operated), ("has_" + source.lower(), F.col(source).isNotNull()), ("has_inputs", inputs)]


def clean(
    df: DataFrame,
    required: Sequence[str] = REQUIRED_TEMPORAL,
    flags: Sequence[str] = ("CANCELLED", "DIVERTED"),
    source: str = "ARRIVAL_DELAY",
) -> DataFrame:
    """Keep rows that operated, have the label source, and have all required inputs. One fused filter."""
    for _, keep in _steps(flags, source, required):
        df = df.where(keep)
    return df


def clean_funnel(
    df: DataFrame,
    required: Sequence[str] = REQUIRED_TEMPORAL,
    flags: Sequence[str] = ("CANCELLED", "DIVERTED"),
    source: str = "ARRIVAL_DELAY",
) -> DataFrame:
    """Rows left and removed after each cleaning step, all from one pass: (step_no, step, remaining, removed)."""
    kept, names, counts = F.lit(True), ["raw"], [F.count("*").alias("raw")]
    for name, keep in _steps(flags, source, required):
        kept = kept & keep
        names.append(name)
        counts.append(F.count_if(kept).alias(name))
    totals = df.agg(*counts)
    rows = [
        F.struct(
            F.lit(i).alias("step_no"), F.lit(n).alias("step"), F.col(n).alias("remaining"),
            (F.col(names[max(i - 1, 0)]) - F.col(n)).alias("removed"),
        )
        for i, n in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*rows)))


def with_label(
    df: DataFrame, source: str = "ARRIVAL_DELAY", limit: float = 15, label: str = "DELAYED", drop_source: bool = True
) -> DataFrame:
    """Add the binary label and drop the column it was made from, which would leak it."""
    labelled = df.withColumn(label, label_gt(source, limit))
    return labelled.drop(source) if drop_source else labelled


def select_model_columns(df: DataFrame, extra: Sequence[str] = ("DELAYED",)) -> DataFrame:
    """The modelling columns with text categories, in their fixed order."""
    picked = [F.col(c).cast("string").alias(c) if c in CATEGORICAL else F.col(c) for c in MODEL_COLUMNS]
    return df.select(*picked, *extra)


def drop_cols(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)
