"""Order statistics without a global sort: range cuts, prefix sums, exact quantiles and exact hash cut-offs.

Common idea: cut the order column into ranges that hold few rows each, total every range (a small table), cumulate
the totals, then finish inside the ranges in parallel. The cuts are literals in the plan, so a task that is run again
after an executor loss puts each row into the same range as before.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latewatch.runtime import BROADCAST_LIMIT_BYTES, BROADCAST_ROW_BYTES, pin

RANGE = "_range"
GROUP = "_group"
# Hex digits of an md5 digest used as a range: 4,096 equal ranges by construction, each with 4,096 fine ones.
HASH_PREFIX_DIGITS = 3
# Ranges come from a sketch, which resolves up to MAX_RANGES of equal weight; a second sketch divides those that are looked into.
MIN_RANGES, MAX_RANGES = 64, 2048
SUBDIVISIONS = 16
SKETCH_GROUPS = 256


def range_edges(df: DataFrame, column: str, ranges: int | None = None) -> list[float]:
    """Ascending cut values that leave few distinct values in each range.

    One pass over one column. Every task fills one small quantile sketch of fixed size; sketches are merged in two levels,
    so the last task merges ``SKETCH_GROUPS`` of them and not one per input split. Only the cuts, a number set by the cluster
    and not by the data, come to the driver. A value too frequent for one range yields equal cuts, which collapse; it then
    sits in a range with few *distinct* values.
    """
    if ranges is None:
        ranges = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranges = max(MIN_RANGES, min(MAX_RANGES, ranges))
    k = F.lit(max(200, 4 * ranges))
    value = F.col(column).cast("double")
    sketch = (
        df.select(value.alias("_v"), F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_g"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .groupBy("_g").agg(F.kll_sketch_agg_double("_v", k).alias("_s"))
        .agg(F.kll_merge_agg_double("_s", k).alias("_s"))
    )
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    filled = F.kll_sketch_get_n_double("_s") > 0
    row = sketch.select(F.when(filled, F.kll_sketch_get_quantile_double("_s", shares)).alias("cuts")).first()
    return sorted({float(v) for v in row["cuts"] or [] if math.isfinite(v)})


def finer(edges: Sequence[float]) -> list[float]:
    """The cuts with every gap between two of them divided evenly: many more ranges without a larger sketch."""
    out = set(edges)
    for lo, hi in zip(edges, edges[1:]):
        out.update(lo + (hi - lo) * i / SUBDIVISIONS for i in range(1, SUBDIVISIONS))
    return sorted(v for v in out if math.isfinite(v))


def with_range(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Add the range number of a numeric column: a monotone, deterministic function of its value."""
    if not edges:
        return df.withColumn(RANGE, F.lit(0))
    splits = [-math.inf, *edges, math.inf]
    source = "_range_source"
    cut = Bucketizer(splits=splits, inputCol=source, outputCol=RANGE, handleInvalid="keep")
    ranged = cut.transform(df.withColumn(source, F.col(column).cast("double")))
    # never NULL, or joins on it would infer an IS NOT NULL filter and evaluate the cut once more per input row
    return ranged.withColumn(RANGE, F.coalesce(F.col(RANGE).cast("int"), F.lit(-1))).drop(source)


def with_group(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the group columns as one struct. A struct of NULLs equals itself, so plain equi-joins keep NULL groups and
    reuse the partitioning of the windows before them."""
    return df.withColumn(GROUP, F.struct(*[F.col(c) for c in by]) if by else F.lit(0))


def _ungroup(by: Sequence[str]) -> list[Column]:
    return [F.col(f"{GROUP}.{c}").alias(c) for c in by]


def _rows_in(rows: DataFrame, hit: DataFrame, groups_bounded: bool) -> DataFrame:
    """Rows that lie in one of the few hit ranges.

    Without groups there are at most as many hits as ranks asked for. With groups their number is measured first: a
    small table is broadcast and the rows stay where they are, a large one is joined by shuffle.
    """
    if not groups_bounded:
        hit = pin(hit)
        if hit.count() * 4 * BROADCAST_ROW_BYTES > BROADCAST_LIMIT_BYTES:
            return rows.join(hit, [GROUP, RANGE])
    return rows.join(F.broadcast(hit), [GROUP, RANGE])


def exact_quantile(
    df: DataFrame,
    column: str,
    q: float = 0.5,
    by: Sequence[str] = (),
    name: str | None = None,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """Exact interpolated quantile per group; one row per group, NULLs ignored.

    The input is read once, to count each value; all else works on the written counts. Totals per coarse range find the one or
    two ranges that hold the wanted ranks; the counts in those are cut again by their own quantiles, so fine ranges are even
    however the values lie. No task ever holds more than one fine range.
    """
    by, name = list(by), name or f"{column}_q"
    values = with_group(df, by).select(GROUP, F.col(column).cast("double").alias("_value")).where("_value IS NOT NULL")
    counted = pin(values.groupBy(GROUP, "_value").agg(F.count("*").alias("_n")))
    edges = range_edges(counted, "_value") if edges is None else edges
    ranged = with_range(counted, "_value", edges)

    upto, whole = Window.partitionBy(GROUP).orderBy(RANGE), Window.partitionBy(GROUP)
    totals = (
        ranged.groupBy(GROUP, RANGE).agg(F.sum("_n").alias("_n"))
        .withColumn("_end", F.sum("_n").over(upto))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumn("_rank", F.lit(float(q)) * (F.sum("_n").over(whole) - 1))
        .withColumn("_low", F.floor("_rank")).withColumn("_high", F.ceil("_rank"))
    )

    def holds(rank: str) -> Column:
        return (F.col("_start") <= F.col(rank)) & (F.col(rank) < F.col("_end"))

    hit = totals.where(holds("_low") | holds("_high")).select(GROUP, RANGE, "_start", "_rank", "_low", "_high")
    state = ["_start", "_rank", "_low", "_high"]
    counts = pin(_rows_in(ranged, hit, not by).select(F.struct(GROUP, RANGE, *state).alias("_hit"), "_value", "_n"))
    fine = range_edges(counts, "_value")
    ranks = prefix_sums(with_range(counts, "_value", fine), "_value", ["_n"], ["_hit"], descending=False).select(
        F.col(f"_hit.{GROUP}").alias(GROUP), "_value", *[F.col(f"_hit.{c}").alias(c) for c in ("_rank", "_low", "_high")],
        (F.col("_hit._start") + F.col("_n_upto")).alias("_end"),
        (F.col("_hit._start") + F.col("_n_upto") - F.col("_n")).alias("_start"),
    )
    low = F.max(F.when(holds("_low"), F.col("_value")))
    high = F.max(F.when(holds("_high"), F.col("_value")))
    share = F.max(F.col("_rank") - F.col("_low"))
    result = (low + (high - low) * share).alias(name)
    return ranks.agg(result) if not by else ranks.groupBy(GROUP).agg(result).select(*_ungroup(by), name)


def prefix_sums(
    counts: DataFrame,
    order: str,
    measures: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = True,
) -> DataFrame:
    """Running sums of ``measures`` along ``order`` inside each group.

    ``counts`` holds one row per (group, order value) and carries its range number. Adds, per measure m:
    ``m_upto`` (sum up to and including the row), ``m_all`` (group total) and ``m_next`` (value of the following row).
    """
    by = list(by)
    toward = F.desc if descending else F.asc
    keyed = with_group(counts, by)
    step = Window.partitionBy(GROUP, RANGE).orderBy(toward(order))
    running = step.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = keyed.withColumns(
        {f"{m}_in": F.sum(m).over(running) for m in measures} | {f"{m}_lead": F.lead(m).over(step) for m in measures}
    )

    first = F.max_by if descending else F.min_by
    totals = keyed.groupBy(GROUP, RANGE).agg(
        *[F.sum(m).alias(f"{m}_range") for m in measures],
        *[first(m, order).alias(f"{m}_first") for m in measures],
    )
    across = Window.partitionBy(GROUP).orderBy(toward(RANGE))
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(GROUP)
    offsets = totals.select(
        GROUP, RANGE,
        *[F.coalesce(F.sum(f"{m}_range").over(before), F.lit(0)).alias(f"{m}_before") for m in measures],
        *[F.sum(f"{m}_range").over(everything).alias(f"{m}_all") for m in measures],
        *[F.lead(f"{m}_first").over(across).alias(f"{m}_following") for m in measures],
    )
    if not by:
        offsets = F.broadcast(offsets)  # at most one row per range
    return inside.join(offsets, [GROUP, RANGE]).select(
        *counts.columns,
        *[(F.col(f"{m}_in") + F.col(f"{m}_before")).alias(f"{m}_upto") for m in measures],
        *[F.col(f"{m}_all") for m in measures],
        *[F.coalesce(f"{m}_lead", f"{m}_following").alias(f"{m}_next") for m in measures],
    )


def hash_cutoffs(df: DataFrame, digest: str, shares: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Per group, the digests that cut it into parts of the cumulative ``shares``; columns ``cut_0 … cut_k``.

    A row with ``digest <= cut_i`` lies in the first ``i + 1`` parts. The digest's leading digits are the coarse ranges and
    its next digits the fine ones, so no sketch is needed. Equal digests (repeated keys) always fall on the same side.
    """
    by = list(by)
    ranged = with_group(df, by).select(
        GROUP, F.col(digest).alias("_digest"), F.substring(digest, 1, HASH_PREFIX_DIGITS).alias(RANGE)
    )
    upto, whole = Window.partitionBy(GROUP).orderBy(RANGE), Window.partitionBy(GROUP)
    totals = (
        ranged.groupBy(GROUP, RANGE).agg(F.count("*").alias("_n"))
        .withColumn("_end", F.sum("_n").over(upto))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumn("_all", F.sum("_n").over(whole))
    )
    places = [f"_place_{i}" for i in range(len(shares))]
    for p, share in zip(places, shares):
        totals = totals.withColumn(p, F.round(F.col("_all") * F.lit(float(share))).cast("bigint"))

    def at(place: str) -> Column:
        return (F.col("_start") < F.col(place)) & (F.col(place) <= F.col("_end"))

    wanted = F.lit(False)
    for p in places:
        wanted = wanted | at(p)
    hit = totals.where(wanted).select(GROUP, RANGE, "_start", *places)
    counts = (
        _rows_in(ranged, hit, not by).select(F.struct(GROUP, RANGE, "_start", *places).alias("_hit"), "_digest")
        .groupBy("_hit", "_digest").agg(F.count("*").alias("_n"))
        .withColumn(RANGE, F.substring("_digest", HASH_PREFIX_DIGITS + 1, HASH_PREFIX_DIGITS))
    )
    ranks = prefix_sums(counts, "_digest", ["_n"], ["_hit"], descending=False).select(
        F.col(f"_hit.{GROUP}").alias(GROUP), "_digest", *[F.col(f"_hit.{p}").alias(p) for p in places],
        (F.col("_hit._start") + F.col("_n_upto")).alias("_end"),
        (F.col("_hit._start") + F.col("_n_upto") - F.col("_n")).alias("_start"),
    )
    cuts = [F.max(F.when(at(p), F.col("_digest"))).alias(f"cut_{i}") for i, p in enumerate(places)]
    return ranks.agg(*cuts) if not by else ranks.groupBy(GROUP).agg(*cuts).select(
        *_ungroup(by), *[f"cut_{i}" for i in range(len(places))]
    )
