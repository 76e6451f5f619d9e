"""Statistics learned on the training split only, and the features made from them.

One grouping-sets pass over the training rows yields every key's label sum and row count and the grand total. The
result is written out once (its lineage ends there), measured, and then looked up by every split or stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch.functions import log_count
from latewatch.operators.profile import _which_set
from latewatch.operators.ranges import exact_quantile
from latewatch.runtime import BROADCAST_LIMIT_BYTES, BROADCAST_ROW_BYTES, lookup_join, pin

TOTAL = ""

# Key column behind each learned feature.
RATE_FEATURES = {
    "AIRLINE_DELAY_RATE": "AIRLINE", "ORIGIN_DELAY_RATE": "ORIGIN_AIRPORT",
    "DEST_DELAY_RATE": "DESTINATION_AIRPORT", "ROUTE_DELAY_RATE": "ROUTE",
}
HOUR_RATE_FEATURES = {"HOUR_DELAY_RATE": "DEP_HOUR"}
COUNT_FEATURES = {
    "ORIGIN_FLIGHTS": "ORIGIN_AIRPORT", "DEST_FLIGHTS": "DESTINATION_AIRPORT", "ROUTE_FLIGHTS": "ROUTE",
}


@dataclass
class KeyStatistics:
    """Label sum and row count per key value, plus the total. ``table``: (key_name, key, positives, n)."""

    table: DataFrame
    positives: int
    n: int
    bytes_per_key: dict[str, int] = field(default_factory=dict)

    @classmethod
    def fit(cls, train: DataFrame, keys: Sequence[str], label: str = "DELAYED") -> KeyStatistics:
        keys = list(dict.fromkeys(keys))
        grouped = train.groupingSets([[F.col(k)] for k in keys] + [[]], *[F.col(k) for k in keys]).agg(
            F.grouping_id().alias("_gid"),
            F.sum(F.col(label).cast("bigint")).alias("positives"),
            F.count(label).alias("n"),
        )
        name, value = _which_set(keys, TOTAL)
        table = grouped.select(name.alias("key_name"), value.alias("key"), "positives", "n")
        # the NULL group is dropped only now, so the total still counts its rows
        return cls._measured(pin(table.where((F.col("key_name") == TOTAL) | F.col("key").isNotNull())))

    @classmethod
    def _measured(cls, table: DataFrame) -> KeyStatistics:
        sizes = table.groupBy("key_name").agg(
            F.sum(F.coalesce(F.octet_length("key"), F.lit(0)) + F.lit(BROADCAST_ROW_BYTES)).alias("bytes"),
            F.sum("positives").alias("positives"),
            F.sum("n").alias("n"),
        ).collect()  # one row per key column
        total = next((r for r in sizes if r["key_name"] == TOTAL), None)
        return cls(
            table,
            int(total["positives"] or 0) if total else 0,
            int(total["n"] or 0) if total else 0,
            {r["key_name"]: int(r["bytes"]) for r in sizes if r["key_name"] != TOTAL},
        )

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> KeyStatistics:
        schema = "key_name string, key string, positives bigint, n bigint"
        return cls._measured(spark.read.schema(schema).parquet(path))

    @property
    def global_rate(self) -> float | None:
        return self.positives / self.n if self.n else None

    def encode(
        self,
        df: DataFrame,
        rates: Mapping[str, str] | None = None,
        counts: Mapping[str, str] | None = None,
        smoothing: float = 0.0,
        limit_bytes: int = BROADCAST_LIMIT_BYTES,
        seen: bool = False,
    ) -> DataFrame:
        """Add rate features (unseen or NULL key → global rate) and log-count features (unseen → 0).

        One lookup per key column serves all features on it. ``limit_bytes`` bounds all broadcast lookups together: the smallest
        are broadcast as long as they fit, the others are joined by shuffle. With ``seen`` a boolean ``<feature>_SEEN`` is added per
        rate feature.
        """
        rates, counts = dict(rates or {}), dict(counts or {})
        overall = F.lit(self.global_rate).cast("double")
        kept = list(df.columns)
        keys, left, broadcast = list(dict.fromkeys([*rates.values(), *counts.values()])), limit_bytes, set()
        for key in sorted(keys, key=lambda k: self.bytes_per_key.get(k, 0)):
            if self.bytes_per_key.get(key, 0) <= left:
                broadcast.add(key)
                left -= self.bytes_per_key.get(key, 0)
        for key in keys:
            stats = self.table.where(F.col("key_name") == key).select(
                F.col("key").alias("_key"), F.col("positives").alias("_p"), F.col("n").alias("_n")
            )
            df = lookup_join(
                df.withColumn("_key", F.col(key).cast("string")), stats, ["_key"],
                0 if key in broadcast else 1, 0,
            )
            added: dict[str, Column] = {}
            for out, k in rates.items():
                if k == key:
                    rate = (F.col("_p") + F.lit(float(smoothing)) * overall) / (F.col("_n") + F.lit(float(smoothing)))
                    added[out] = F.coalesce(F.when(F.col("_n") > 0, rate), overall)
                    if seen:
                        added[f"{out}_SEEN"] = F.col("_n").isNotNull()
            for out, k in counts.items():
                if k == key:
                    added[out] = log_count("_n")
            df = df.withColumns(added)
            kept += added
            df = df.select(*kept)
        return df


@dataclass
class StatisticsHistory:
    """Key statistics of separate versions (days, months, uploads) in one folder, a partition each. Sums merge, so what is current needs
    the saved sums only, never the rows behind them.

    ``add`` fits one version and replaces it alone, also if it is added again; ``remove`` takes one out. ``current`` adds up the versions from ``since`` to ``until``
    (inclusive, in text order), reading their partitions only; it equals a fit on all their rows together.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    label: str = "DELAYED"

    def add(self, version: str, rows: DataFrame) -> None:
        KeyStatistics.fit(rows, self.keys, self.label).table.write.mode("overwrite").parquet(self._folder(version))

    def add_all(self, rows: DataFrame, version: Column) -> None:
        """Many versions from one pass: rows carry their version, and only the versions that occur are replaced."""
        keys = list(dict.fromkeys(self.keys))
        versioned = rows.withColumn("_version", version.cast("string"))
        sets = [[F.col("_version"), F.col(k)] for k in keys] + [[F.col("_version")]]
        grouped = versioned.groupingSets(sets, F.col("_version"), *[F.col(k) for k in keys]).agg(
            F.grouping_id().alias("_gid"), F.sum(F.col(self.label).cast("bigint")).alias("positives"), F.count(self.label).alias("n"),
        )
        name, value = _which_set(keys, TOTAL)
        table = grouped.select(name.alias("key_name"), value.alias("key"), "positives", "n", F.col("_version").alias("version"))
        table = table.where((F.col("key_name") == TOTAL) | F.col("key").isNotNull())
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(self.path)

    def remove(self, version: str) -> bool:
        """Take a version out; whether there was one."""
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(self._folder(version))
        return folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)

    def saved(self) -> DataFrame:
        schema = "key_name string, key string, positives bigint, n bigint, version string"
        return self.spark.read.schema(schema).parquet(self.path)

    def current(self, since: str | None = None, until: str | None = None) -> KeyStatistics:
        table = self.saved()
        if since is not None:
            table = table.where(F.col("version") >= since)
        if until is not None:
            table = table.where(F.col("version") <= until)
        merged = table.groupBy("key_name", "key").agg(F.sum("positives").alias("positives"), F.sum("n").alias("n"))
        return KeyStatistics._measured(pin(merged))

    def _folder(self, version: str) -> str:
        if not version or any(c in version for c in "/\\:=%*?{}[]\"'#^"):
            raise ValueError(f"not a version name: {version!r}")
        return f"{self.path}/version={version}"


@dataclass
class TargetEncoding:
    """Mean label per key, optionally smoothed towards the global mean: (sum + m·global) / (n + m)."""

    statistics: KeyStatistics
    features: Mapping[str, str]
    smoothing: float = 0.0

    @classmethod
    def fit(
        cls, train: DataFrame, features: Mapping[str, str] = RATE_FEATURES, label: str = "DELAYED",
        smoothing: float = 0.0,
    ) -> TargetEncoding:
        return cls(KeyStatistics.fit(train, list(features.values()), label), features, smoothing)

    def transform(self, df: DataFrame, **options) -> DataFrame:
        return self.statistics.encode(df, rates=self.features, smoothing=self.smoothing, **options)


@dataclass
class VolumeEncoding:
    """log(1 + training rows) per key."""

    statistics: KeyStatistics
    features: Mapping[str, str]

    @classmethod
    def fit(
        cls, train: DataFrame, features: Mapping[str, str] = COUNT_FEATURES, label: str = "DELAYED"
    ) -> VolumeEncoding:
        return cls(KeyStatistics.fit(train, list(features.values()), label), features)

    def transform(self, df: DataFrame, **options) -> DataFrame:
        return self.statistics.encode(df, counts=self.features, **options)


@dataclass
class MedianImputer:
    """Fills NULLs of one column with the exact median of the rows it was fitted on, or of each row's own split."""

    column: str
    median: float | None = None
    per_group: DataFrame | None = None
    by: str | None = None

    @classmethod
    def fit(cls, df: DataFrame, column: str, by: str | None = None) -> MedianImputer:
        if by is None:
            row = exact_quantile(df, column, 0.5, (), "m").first()
            return cls(column, median=row["m"])
        return cls(column, per_group=pin(exact_quantile(df, column, 0.5, [by], "_median")), by=by)

    def transform(self, df: DataFrame) -> DataFrame:
        if self.by is None:
            return df.withColumn(self.column, F.coalesce(self.column, F.lit(self.median).cast("double")))
        medians = self.per_group.withColumnRenamed(self.by, "_group")
        if self.per_group.count() * BROADCAST_ROW_BYTES <= BROADCAST_LIMIT_BYTES:
            medians = F.broadcast(medians)
        filled = df.join(medians, F.col(self.by).eqNullSafe(F.col("_group")), "left")
        return filled.withColumn(self.column, F.coalesce(self.column, "_median")).select(*df.columns)
