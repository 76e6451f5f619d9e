"""Readers. Every one has an explicit schema and is a single lazy scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latewatch.functions import truth_time
from latewatch.schemas import (
    AIRLINE_COLUMNS, AIRPORT_COLUMNS, FLIGHT_COLUMNS, SPLIT_COLUMNS, TRUTH_SCHEMA, matrix_schema, schema_of,
    string_schema,
)

CORRUPT = "_corrupt_record"


def read_flights(spark: SparkSession, path: str | Sequence[str], keep_corrupt: bool = False) -> DataFrame:
    """The 31-column flights CSV with header.

    Whole numbers are read as doubles and then cast, because writers print nullable integers as ``930.0``. Cells that do not
    parse, are not whole, not a number or too large become NULL, the other cells of their line stay; with ``keep_corrupt`` the text of
    lines that do not parse is kept in ``_corrupt_record``.
    """
    wide = {n: "double" if t == "int" else t for n, t in FLIGHT_COLUMNS.items()}
    schema = schema_of(wide)
    if keep_corrupt:
        schema = schema.add(CORRUPT, T.StringType())
    raw = (
        spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    )
    typed = [_whole(n).alias(n) if t == "int" else F.col(n) for n, t in FLIGHT_COLUMNS.items()]
    return raw.select(*typed, *([CORRUPT] if keep_corrupt else []))


def _whole(name: str) -> Column:
    """A double as an int if it is a whole number that fits, else NULL."""
    c = F.col(name)
    return F.when(c == F.floor(c), c.try_cast("int"))


def read_lookup(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A lookup CSV with header; numbers that do not parse become NULL. Small files are broadcast by the optimizer."""
    raw = spark.read.schema(string_schema(columns)).option("header", True).csv(path)
    return raw.select(*[F.col(n).try_cast(t).alias(n) for n, t in columns.items()])


def read_airlines(spark: SparkSession, path: str) -> DataFrame:
    return read_lookup(spark, path, AIRLINE_COLUMNS)


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    return read_lookup(spark, path, AIRPORT_COLUMNS)


def read_splits(
    spark: SparkSession,
    directory: str,
    names: Sequence[str] = ("train", "val", "test", "prod"),
    optional: Sequence[str] = ("prod",),
    columns: dict[str, str] = SPLIT_COLUMNS,
) -> DataFrame:
    """Header CSV splits as one frame with a ``split`` column.

    Accepts both layouts: ``<dir>/split=<name>/`` as written by ``write_splits`` and ``<dir>/<name>.csv``.
    """
    out = None
    for name in names:
        df = None
        for path in (f"{directory}/split={name}", f"{directory}/{name}.csv"):
            try:
                df = spark.read.schema(schema_of(columns)).option("header", True).csv(path)
                break
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        if df is None:
            if name in optional:
                continue
            raise FileNotFoundError(f"no split '{name}' in {directory}")
        df = df.withColumn("split", F.lit(name))
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise FileNotFoundError(f"no split in {directory}")
    return out


def read_matrix_csv(
    spark: SparkSession, path: str | Sequence[str], features: Sequence[str], label: str | None = "DELAYED"
) -> DataFrame:
    """A headerless matrix: columns by position, the label first."""
    return spark.read.schema(matrix_schema(list(features), label)).option("header", False).csv(path)


def read_features(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Parquet features; only ``columns`` are read from the files."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df if columns is None else df.select(*columns)


def read_tree(
    spark: SparkSession, directory: str, fmt: str = "csv", schema: T.StructType | None = None, header: bool = False
) -> DataFrame:
    """All files of one kind below a directory, at any depth, as one scan. No file at all is an error."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported format: {fmt}")
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{fmt}")
    if fmt == "csv":
        if schema is None:
            raise ValueError("CSV needs a schema")
        df = reader.schema(schema).option("header", header).csv(directory)
    else:
        # without files there is no footer to take the schema from, which Spark reports itself
        reader = reader.schema(schema) if schema is not None else reader
        try:
            df = reader.parquet(directory)
        except AnalysisException as e:
            if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                raise FileNotFoundError(f"no .{fmt} files below {directory}") from e
            raise
    if df.select(F.lit(1)).isEmpty() and not df.inputFiles():
        raise FileNotFoundError(f"no .{fmt} files below {directory}")
    return df


def read_predictions(spark: SparkSession, path: str, threshold: float = 0.5) -> DataFrame:
    """Batch-prediction output, one probability per line, with the class at ``threshold``."""
    raw = spark.read.schema(schema_of({"probability": "double"})).option("header", False).csv(path)
    return raw.withColumn("prediction", (F.col("probability") >= threshold).cast("int"))


def read_ground_truth(spark: SparkSession, directory: str) -> DataFrame:
    """(id, label, truth_ts) from ground-truth JSON lines below ``directory``; the time is in the record or else in the path."""
    raw = (
        spark.read.schema(TRUTH_SCHEMA).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*")
        .json(directory)
    )
    return flatten_truth(raw)


def flatten_truth(raw: DataFrame) -> DataFrame:
    """Flat truth rows of a batch or streaming read of nested ground-truth records."""
    return raw.select(
        F.col("eventMetadata.eventId").alias("id"),
        F.col("groundTruthData.data").try_cast("int").alias("label"),
        F.coalesce(F.timestamp_micros("uploadMicros"), truth_time(F.col("_metadata.file_path"))).alias("truth_ts"),
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
