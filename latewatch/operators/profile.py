"""Exploration: balance, distributions, rates, missing values, split summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latewatch.functions import exceeds, percent, safe_ratio, severity
from latewatch.operators.ranges import exact_quantile


def target_summary(df: DataFrame, column: str = "ARRIVAL_DELAY", limit: float = 15) -> DataFrame:
    """Counts and percents of late, on-time and missing rows and the on-time : late ratio, in one pass."""
    c = F.col(column)
    counts = df.agg(
        F.count("*").alias("total"),
        F.count_if(c > limit).alias("delayed"),
        F.count_if(c <= limit).alias("on_time"),
        F.count_if(c.isNull()).alias("missing"),
    )
    return counts.select(
        "*",
        percent("delayed", "total").alias("delayed_pct"),
        percent("on_time", "total").alias("on_time_pct"),
        percent("missing", "total").alias("missing_pct"),
        safe_ratio("on_time", "delayed").alias("imbalance"),
    )


def value_counts(df: DataFrame, column: str | Column, name: str = "value") -> DataFrame:
    """Rows per value, NULL not counted."""
    c = F.col(column) if isinstance(column, str) else column
    return df.select(c.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))


def top_k(df: DataFrame, column: str, k: int = 10, name: str = "value") -> DataFrame:
    """The ``k`` most frequent values; equal counts in value order."""
    return value_counts(df, column, name).orderBy(F.desc("n"), F.asc(name)).limit(k)


def rate_by(
    df: DataFrame,
    columns: str | Sequence[str],
    source: str = "ARRIVAL_DELAY",
    limit: float = 15,
    null_as_false: bool = True,
) -> DataFrame:
    """Late percentage per value of one column: (column…, n, rate, severity), highest first.

    With ``null_as_false`` a row without a delay counts as not late but stays in the denominator, which is how rates
    on uncleaned data come out.
    """
    keys = [columns] if isinstance(columns, str) else list(columns)
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    rates = df.groupBy(*keys).agg(F.count("*").alias("n"), _rate(source, limit, null_as_false).alias("rate"))
    return rates.withColumn("severity", severity("rate")).orderBy(F.desc("rate"), *keys)


def _rate(source: str, limit: float, null_as_false: bool) -> Column:
    late = exceeds(source, limit) if null_as_false else F.col(source) > limit
    return F.avg(late.cast("int")) * 100


def rates_by_each(
    df: DataFrame,
    columns: Sequence[str],
    source: str = "ARRIVAL_DELAY",
    limit: float = 15,
    null_as_false: bool = True,
) -> DataFrame:
    """Late percentage for every column separately plus the overall line, in one scan by grouping sets.

    Rows: (dimension, value, n, rate, severity); the overall row has dimension ``overall`` and a NULL value.
    """
    columns = list(columns)
    grouped = df.groupingSets([[F.col(c)] for c in columns] + [[]], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_gid"),
        F.count("*").alias("n"),
        _rate(source, limit, null_as_false).alias("rate"),
    )
    dimension, value = _which_set(columns)
    return (
        grouped.select(dimension.alias("dimension"), value.alias("value"), "n", "rate")
        .where((F.col("dimension") == "overall") | F.col("value").isNotNull())
        .withColumn("severity", severity("rate"))
    )


def _which_set(columns: Sequence[str], total: str = "overall") -> tuple[Column, Column]:
    """(name, value) of the single column a grouping-sets row is grouped by; ``_gid`` has a 0 bit for it."""
    full = (1 << len(columns)) - 1
    name, value = None, None
    for i, c in enumerate(columns):
        mine = F.col("_gid") == (full ^ (1 << (len(columns) - 1 - i)))
        text = F.col(c).cast("string")
        name = F.when(mine, c) if name is None else name.when(mine, c)
        value = F.when(mine, text) if value is None else value.when(mine, text)
    return name.otherwise(total), value


def n_distinct(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row with the number of distinct values of each column."""
    f = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[f(F.col(c)).alias(f"{c}_distinct") for c in columns])


# Standard error of a sketch: about 1.04 / sqrt(2 ** SKETCH_BITS), 1.6 %.
SKETCH_BITS = 12


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str], bits: int = SKETCH_BITS) -> DataFrame:
    """One row per group with a sketch of the distinct values of each column, of fixed size, to be stored and merged later without the rows."""
    kinds = dict(df.dtypes)
    plain = lambda c: F.col(c) if kinds[c] in ("int", "bigint", "string", "binary") else F.col(c).cast("string")
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(plain(c), F.lit(bits)).alias(c) for c in columns])


def merge_sketches(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups (or of everything) from stored ones."""
    return sketches.groupBy(*by).agg(*[F.hll_union_agg(c, F.lit(False)).alias(c) for c in columns])


def sketch_counts(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Estimated numbers of distinct values, one column ``<name>_distinct`` each."""
    return sketches.select(*by, *[F.hll_sketch_estimate(c).alias(f"{c}_distinct") for c in columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def split_summary(df: DataFrame, label: str = "DELAYED", split: str = "split") -> DataFrame:
    """Rows, percent of all rows and late percentage per split. The total is taken from the split counts, a handful of
    rows, so the table is read once."""
    per_split = df.groupBy(split).agg(
        F.count("*").alias("n"),
        F.count_if(F.col(label) == 1).alias("n_delayed"),
        (F.avg(F.col(label).cast("double")) * 100).alias("delay_rate"),
    )
    return per_split.withColumn("pct", percent("n", F.sum("n").over(Window.partitionBy())))


def split_detail(
    df: DataFrame,
    distinct: Sequence[str] = ("AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT"),
    means: Sequence[str] = ("DISTANCE", "SCHEDULED_TIME"),
    split: str = "split",
) -> DataFrame:
    """Distinct keys and mean inputs per split."""
    return df.groupBy(split).agg(
        F.count("*").alias("n"),
        *[F.count_distinct(F.col(c)).alias(f"{c}_distinct") for c in distinct],
        *[F.avg(c).alias(f"{c}_mean") for c in means],
    )


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column and percent (2 digits): one pass over the table, then one row per column."""
    columns = list(columns or df.columns)
    totals = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"m_{i}") for i, c in enumerate(columns)]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"m_{i}").alias("n_missing"),
            percent(f"m_{i}", "_rows", 2).alias("pct_missing"),
        )
        for i, c in enumerate(columns)
    ]
    return totals.select(F.inline(F.array(*rows)))


def median(df: DataFrame, column: str, by: Sequence[str] = (), exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """Median per group: exact with interpolation, or the one-pass approximation."""
    name = f"{column}_median"
    if exact:
        return exact_quantile(df, column, 0.5, by, name)
    return df.groupBy(*by).agg(F.percentile_approx(column, 0.5, accuracy).cast("double").alias(name))


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """Equal-width histogram over [min, max]; the maximum belongs to the last bin, empty bins are listed with 0.

    The limits are two exact numbers, so they are fetched first and the binning is one map-side-combined count.
    """
    c = F.col(column).cast("double")
    limits = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).first()
    lo, hi = limits["lo"], limits["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, lower double, upper double, n bigint")
    if lo == hi:  # one value: a unit-wide histogram around it
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    index = F.least(F.floor((c - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.where(c.isNotNull()).groupBy(index.alias("bin")).agg(F.count("*").alias("n"))
    frame = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def pos_weight(df: DataFrame, label: str = "DELAYED", cap: float | None = None) -> DataFrame:
    """negatives / positives, optionally capped."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives")
    )
    weight = safe_ratio("negatives", "positives")
    if cap is not None:
        # ``least`` skips NULLs; keep "no positives" as NULL
        weight = F.when(weight.isNotNull(), F.least(weight, F.lit(float(cap))))
    return counts.withColumn("pos_weight", weight)


def score_stats(df: DataFrame, score: str = "probability", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(score).alias("n"), F.avg(score).alias("mean_score"),
        F.min(score).alias("min_score"), F.max(score).alias("max_score"),
    )


def prediction_summary(
    df: DataFrame, threshold: float = 0.5, score: str = "probability", by: Sequence[str] = ()
) -> DataFrame:
    """How many rows fall on either side of the threshold, and in percent."""
    counts = df.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(F.col(score) < threshold).alias("on_time"),
        F.count_if(F.col(score) >= threshold).alias("delayed"),
    )
    return counts.select(
        "*", percent("on_time", "total").alias("on_time_pct"), percent("delayed", "total").alias("delayed_pct")
    )


def verify_splits(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    label: str = "DELAYED",
    split: str = "split",
) -> DataFrame:
    """Per split: rows, label counts, NULL cells and a status, from one pass over a frame with a split column."""
    columns = list(columns or [c for c in df.columns if c != split])
    nulls = sum((F.count_if(F.col(c).isNull()) for c in columns[1:]), F.count_if(F.col(columns[0]).isNull()))
    return df.groupBy(split).agg(
        F.count("*").alias("n"),
        F.count_if(F.col(label) == 1).alias("n_delayed"),
        F.count_if(F.col(label) == 0).alias("n_on_time"),
        (F.avg(F.col(label).cast("double")) * 100).alias("delay_rate"),
        nulls.alias("n_missing"),
    ).select(
        "*", F.lit(len(columns)).alias("n_columns"),
        F.when(F.col("n_missing") == 0, "OK").otherwise("WARNING").alias("status"),
    )


def verify_split_frames(frames: Mapping[str, DataFrame], reference: str = "train", label: str = "DELAYED") -> DataFrame:
    """The same report for separately stored splits, plus whether each has the reference's columns in order."""
    want = frames[reference].columns
    out = None
    for name, df in frames.items():
        report = verify_splits(df.withColumn("split", F.lit(name)), df.columns, label).withColumn(
            "schema_matches", F.lit(df.columns == want)
        )
        out = report if out is None else out.unionByName(report)
    return out
