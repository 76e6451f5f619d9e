"""External tables, databases, typed views and table counts through Spark SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch.functions import whole_number


def _quote(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION {_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quote(name)}{where}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quote(name)}")


def register_external(
    spark: SparkSession, name: str, path: str, columns: Iterable[str], header: bool = True, sep: str = ",",
    quote: str = '"', replace: bool = True,
) -> DataFrame:
    """All-text external table over a CSV file or folder; the files stay where they are."""
    if replace:
        drop_table(spark, name)
    body = ", ".join(f"`{c}` STRING" for c in columns)
    spark.sql(
        f"CREATE TABLE {_quote(name)} ({body}) USING csv "
        f"OPTIONS (header {_literal(str(header).lower())}, sep {_literal(sep)}, quote {_literal(quote)}) "
        f"LOCATION {_literal(path)}"
    )
    return spark.table(name)


replace_table = register_external


def typed_view(df: DataFrame, columns: dict[str, str], via_double: bool = True) -> DataFrame:
    """Typed projection of an all-text table; text that does not parse becomes NULL.

    ``via_double`` also accepts whole numbers printed as ``930.0`` or ``1e3``, exactly; fractions and ``NaN`` are NULL.
    """

    return df.select(*[_typed(n, t, via_double).alias(n) for n, t in columns.items()])


def _typed(name: str, kind: str, via_double: bool) -> Column:
    if kind in ("int", "bigint") and via_double:
        return whole_number(F.col(name), kind)
    return F.col(name).try_cast(kind)


def bad_casts(df: DataFrame, columns: dict[str, str], via_double: bool = True) -> DataFrame:
    """Per column, how many non-NULL texts ``typed_view`` turns into NULL, from one pass."""
    names = list(columns)
    totals = df.agg(*[
        F.count_if(F.col(n).isNotNull() & _typed(n, t, via_double).isNull()).alias(f"b_{i}")
        for i, (n, t) in enumerate(columns.items())
    ])
    rows = [F.struct(F.lit(n).alias("column"), F.col(f"b_{i}").alias("n_bad")) for i, n in enumerate(names)]
    return totals.select(F.inline(F.array(*rows)))


def table_counts(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """(table_name, n) of each catalog table or view."""
    selects = [f"SELECT {_literal(n)} AS table_name, COUNT(*) AS n FROM {_quote(n)}" for n in names]
    return spark.sql(" UNION ALL ".join(selects))
