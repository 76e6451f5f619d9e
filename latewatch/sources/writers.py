"""Writers. What they write is there as a whole or not at all (``manifest.publish``), but for ground truth, which is appended. ``if_exists='skip'`` leaves a
whole output alone, so a rerun only writes what is not there yet."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch.functions.scalar import format_utc, truth_struct
from latewatch.operators.matrix import assert_numeric, select_matrix
from latewatch.operators.splits import first_n
from latewatch.runtime import pin
from latewatch.schemas import SPLIT_COLUMNS
from latewatch.sources.manifest import finished, publish

# Folder name of each split in a matrix.
MATRIX_FOLDERS = {"train": "train", "val": "validation", "test": "test", "prod": "production"}


def _write(df: DataFrame, path: str, fmt: str, if_exists: str, partition_by: tuple[str, ...] = (), **options) -> None:
    if if_exists == "append":
        df.write.mode("append").format(fmt).options(**options).partitionBy(*partition_by).save(path)
    elif if_exists in ("overwrite", "skip", "error"):
        publish(df, path, fmt, if_exists, partition_by, **options)
    else:
        raise ValueError(f"unknown policy for an output that exists: {if_exists}")


def write_splits(
    df: DataFrame, directory: str, columns: Sequence[str] = tuple(SPLIT_COLUMNS), header: bool = True,
    if_exists: str = "overwrite",
) -> None:
    """Header CSV, one ``split=<name>`` folder per split, all in one job."""
    _write(df.select(*columns, "split"), directory, "csv", if_exists, ("split",), header=header)


def write_matrix_csv(
    df: DataFrame, directory: str, features: str | Sequence[str], label: str | None = "DELAYED",
    splits: Sequence[str] | None = None, if_exists: str = "overwrite",
) -> None:
    """Headerless CSV, label first. With ``splits`` one folder per split (train, validation, test, production)."""
    if splits is None:
        matrix = assert_numeric(select_matrix(df, features, label))
        _write(matrix, directory, "csv", if_exists, header=False)
        return
    targets = {name: f"{directory}/{MATRIX_FOLDERS.get(name, name)}" for name in splits}
    if if_exists == "skip":
        targets = {name: path for name, path in targets.items() if not finished(df.sparkSession, path)}
    if not targets:
        return
    matrix = select_matrix(df.where(F.col("split").isin(*targets)), features, label, keep=["split"])
    assert_numeric(matrix.drop("split"))
    if len(targets) > 1:
        matrix = pin(matrix)  # the plan behind it runs once, not once per split
    for name, path in targets.items():
        _write(matrix.where(F.col("split") == name).drop("split"), path, "csv", if_exists, header=False)


def write_features(df: DataFrame, directory: str, if_exists: str = "overwrite") -> None:
    """Snappy Parquet, partitioned by split so a reader of one split skips the others."""
    _write(df, directory, "parquet", if_exists, ("split",), compression="snappy")


def write_report(df: DataFrame, path: str, if_exists: str = "overwrite") -> None:
    """Nested evaluation or rejection reports, one JSON document per line."""
    _write(df, path, "json", if_exists, ignoreNullFields=False)


def write_scored(df: DataFrame, path: str, if_exists: str = "overwrite", label: str = "label") -> None:
    """``probability,prediction,label`` CSV with header."""
    _write(df.select("probability", "prediction", label), path, "csv", if_exists, header=True)


def write_inference_input(
    df: DataFrame, path: str, features: str | Sequence[str], n: int | None = None,
    order_by: str | Sequence[str] | None = None, if_exists: str = "overwrite",
) -> None:
    """Headerless features without the label; with ``n`` the first rows in ``order_by`` order."""
    if n is not None:
        if order_by is None:
            raise ValueError("a subset needs an order: rows have none of their own")
        df = first_n(df, n, order_by)
    _write(assert_numeric(select_matrix(df, features, None)), path, "csv", if_exists, header=False)


def write_ground_truth(
    df: DataFrame, directory: str, at: datetime | None = None, id: str = "id", label: str = "label"
) -> str:
    """Upload one batch of labels as JSON lines under ``YYYY/MM/DD/HH/MMSS.jsonl`` and return that path.

    The path is a folder of part files, so a batch of any size is written in parallel.
    """
    at = at or datetime.now(timezone.utc)
    path = f"{directory}/{at:%Y/%m/%d/%H/%M%S}.jsonl"
    df.select(truth_struct(label, id).alias("t")).select("t.*").write.mode("append").json(path)
    return path


def write_ground_truth_table(
    df: DataFrame, directory: str, ts: str, id: str = "id", label: str = "label", if_exists: str = "append", by_hour: bool = True
) -> None:
    """Labels of many uploads in one job; the readers accept both layouts.

    Folders are the day and hour (UTC) of ``ts``, or the day alone, for pruning only; each record keeps the full time.
    """
    folders = ["upload_date", "upload_hour"] if by_hour else ["upload_date"]
    rows = df.select(
        truth_struct(label, id).alias("t"), F.unix_micros(F.col(ts).cast("timestamp")).alias("uploadMicros"),
        format_utc(ts, "yyyy-MM-dd").alias("upload_date"), format_utc(ts, "HH").alias("upload_hour"),
    )
    # few files per folder, and an hour with very many labels is still written in parallel
    rows = rows.select("t.*", "uploadMicros", *folders).hint("rebalance", *folders)
    _write(rows, directory, "json", if_exists, tuple(folders))
