"""Row features, feature matrices and their checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latewatch import functions as fn
from latewatch.schemas import FEATURE_SETS


def add_temporal_features(df: DataFrame, late_night: bool = False) -> DataFrame:
    """DEP_HOUR, HOUR_SIN, HOUR_COS, IS_PEAK_HOUR, IS_WEEKEND and, if wanted, IS_LATE_NIGHT."""
    df = df.withColumn("DEP_HOUR", fn.dep_hour("SCHEDULED_DEPARTURE"))
    sin, cos = fn.cyclic("DEP_HOUR")
    columns = {
        "HOUR_SIN": sin, "HOUR_COS": cos,
        "IS_PEAK_HOUR": fn.is_peak("DEP_HOUR"), "IS_WEEKEND": fn.is_weekend("DAY_OF_WEEK"),
    }
    if late_night:
        columns["IS_LATE_NIGHT"] = fn.is_late_night("DEP_HOUR")
    return df.withColumns(columns)


def add_distance_features(df: DataFrame, strict: bool = False) -> DataFrame:
    """IS_LONG_HAUL and DISTANCE_BUCKET."""
    return df.withColumns({
        "IS_LONG_HAUL": fn.is_long_haul("DISTANCE"),
        "DISTANCE_BUCKET": fn.band_right_closed("DISTANCE", strict=strict),
    })


def add_route(df: DataFrame) -> DataFrame:
    return df.withColumn("ROUTE", fn.route("ORIGIN_AIRPORT", "DESTINATION_AIRPORT"))


def add_store_keys(df: DataFrame, year: int) -> DataFrame:
    """flight_id and event_time of a feature-store row."""
    return df.withColumns({
        "flight_id": fn.flight_id(
            year, "MONTH", "DAY", "AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "SCHEDULED_DEPARTURE"
        ),
        "event_time": fn.event_time(year, "MONTH", "DAY"),
    })


def select_matrix(
    df: DataFrame, features: str | Sequence[str], label: str | None = "DELAYED", keep: Sequence[str] = ()
) -> DataFrame:
    """Label first, then the features of a named set or list, in order; ``keep`` columns go last."""
    names = FEATURE_SETS[features] if isinstance(features, str) else list(features)
    return df.select(*([label] if label else []), *names, *keep)


def split_xy(df: DataFrame, label: str = "DELAYED") -> tuple[DataFrame, DataFrame]:
    """(features, label) as two projections of one frame."""
    return df.drop(label), df.select(label)


def non_numeric_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, T.NumericType)]


def non_numeric_columns(df: DataFrame, samples: int = 5) -> DataFrame:
    """Each non-numeric column with its first few distinct values in value order: (column, type, value).

    One scan for all columns. Distinct values are found with map-side combine; a column with very many of them shuffles them once,
    and the window then keeps the first ``samples`` of each task before it gathers them.
    """
    fields = [f for f in df.schema if not isinstance(f.dataType, T.NumericType)]
    if not fields:
        return df.sparkSession.createDataFrame([], "column string, type string, value string")
    cells = F.array(*[
        F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"`{f.name}`").cast("string").alias("value"),
        )
        for f in fields
    ])
    values = df.select(F.inline(cells)).where("value IS NOT NULL").distinct()
    place = F.row_number().over(Window.partitionBy("column", "type").orderBy("value"))
    return values.withColumn("_place", place).where(F.col("_place") <= samples).drop("_place")


def assert_numeric(df: DataFrame) -> DataFrame:
    """The frame itself, or an error naming the columns a matrix may not have."""
    bad = non_numeric_names(df)
    if bad:
        raise ValueError(f"non-numeric columns in a feature matrix: {', '.join(bad)}")
    return df
