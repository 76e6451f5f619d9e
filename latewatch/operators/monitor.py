"""Model quality over time: baseline, constraints, ground-truth matching, windowed evaluation, alarm."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latewatch.functions import hash_hex
from latewatch.operators.metrics import evaluate, unpivot_metrics
from latewatch.operators.splits import first_n
from latewatch.runtime import BROADCAST_LIMIT_BYTES, BROADCAST_ROW_BYTES, pin

# Sample sizes, periods and the names of the comparison operators.
BASELINE_SIZE = 500
ALARM_PERIOD_SECONDS = 600
ALARM_THRESHOLD = 0.20
BELOW, ABOVE = "LessThanThreshold", "GreaterThanThreshold"
BASELINE_METRICS = ("f1_score", "precision", "recall", "accuracy", "auc")


def baseline(
    scored: DataFrame, n: int = BASELINE_SIZE, order_by: str | Sequence[str] = "id", threshold: float = 0.5,
    score: str = "probability", label: str = "label", by: Sequence[str] = (),
) -> DataFrame:
    """Metrics of the first ``n`` scored rows in key order, of all rows or of each group."""
    if not by:
        return evaluate(first_n(scored, n, order_by), threshold, (), score, label)
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*keys))  # a rank limit: each task first drops what is past ``n``
    return evaluate(scored.withColumn("_place", place).where(F.col("_place") <= n).drop("_place"), threshold, by, score, label)


def suggest_constraints(
    baseline_metrics: DataFrame, names: Sequence[str] = BASELINE_METRICS, by: Sequence[str] = ()
) -> DataFrame:
    """One constraint per metric (and group): production must not fall below the baseline value."""
    return unpivot_metrics(baseline_metrics, by, names).select(
        *by, "metric", F.col("value").alias("threshold"), F.lit(BELOW).alias("comparison_operator")
    )


# Up to this many times a row is drawn again; more has a chance below 1e-9.
_MOST_DRAWS = 12


def poisson_draws(key: Column | str | Sequence[Column | str], seed: object = 0) -> Column:
    """How often a row is in a replicate: a Poisson number of mean 1, made from a hash of ``key`` and therefore the same on every run and retry."""
    uniform = F.conv(F.substring(hash_hex(key, seed), 1, 8), 16, 10).cast("double") / 2**32
    shares = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(_MOST_DRAWS)]
    return sum(((uniform >= x).cast("int") for x in shares), F.lit(0))


def bootstrap_metrics(
    scored: DataFrame, replicates: int = 200, by: Sequence[str] = (), key: str | Sequence[str] = "id", threshold: float = 0.5, seed: object = 0,
    score: str = "probability", label: str = "label",
) -> DataFrame:
    """Full evaluation of ``replicates`` resampled versions of the rows (of each group), numbered from 1, all from one pass.

    Each row draws its weight in each replicate from a hash, so nothing is sampled in order or moved before it is counted: what is shuffled are counts per
    (group, replicate, distinct score).
    """
    keys = [key] if isinstance(key, str) else list(key)
    many = scored.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    drawn = many.withColumn("_draws", poisson_draws(["replicate", *keys], seed)).where("_draws > 0")
    return evaluate(drawn, threshold, [*by, "replicate"], score, label, weight="_draws")


def bounded_constraints(
    scored: DataFrame, n: int = BASELINE_SIZE, order_by: str | Sequence[str] = "id", level: float = 0.95, replicates: int = 200, threshold: float = 0.5,
    names: Sequence[str] = BASELINE_METRICS, by: Sequence[str] = (), seed: object = 0, score: str = "probability", label: str = "label",
) -> DataFrame:
    """One constraint per metric (and group) with a margin: the value that ``level`` of the resampled baselines reach.

    The bare baseline value is missed by half of all samples of an unchanged model. The baseline is the first ``n`` rows in key order, as in ``baseline``.
    A metric that no replicate has, as the AUC of one class, gives a NULL threshold.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    if by:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*keys))
        first = scored.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")
    else:
        first = first_n(scored, n, order_by)
    drawn = bootstrap_metrics(first, replicates, by, keys, threshold, seed, score, label)
    bounds = drawn.groupBy(*by).agg(*[F.percentile(m, 1 - level).alias(m) for m in names])
    return suggest_constraints(bounds, names, by)


def violations(
    current: DataFrame, constraints: DataFrame, ids: Sequence[str] = (), names: Sequence[str] = BASELINE_METRICS,
    only_violated: bool = True, by: Sequence[str] = (), missing: str = "not_violated",
) -> DataFrame:
    """Compare a wide metrics table, one row per ``ids``, with the constraints, metric by metric.

    Constraints are joined on the metric and the columns ``by``, whatever their number; they are broadcast if they are measured
    to be small. A constraint on a metric that is not in ``names``, or with an unknown operator, is an error. A NULL metric or
    threshold is not violated, or violated with ``missing='violated'``. Rows without a constraint are left out.
    """
    if missing not in ("violated", "not_violated"):
        raise ValueError(f"unknown policy for missing metrics: {missing}")
    by = list(by)
    settings = pin(constraints.select(*by, "metric", "threshold", "comparison_operator"))
    n, wrong, odd = settings.select(
        F.count("*"), F.min(F.when(~F.coalesce(F.col("metric").isin(*names), F.lit(False)), F.coalesce("metric", F.lit("NULL")))),
        F.min(F.when(~F.coalesce(F.col("comparison_operator").isin(BELOW, ABOVE), F.lit(False)), F.coalesce("comparison_operator", F.lit("NULL")))),
    ).first()
    if wrong is not None:
        raise ValueError(f"a constraint names an unknown metric: {wrong}")
    if odd is not None:
        raise ValueError(f"unknown comparison operator: {odd}")
    if n * (BROADCAST_ROW_BYTES + 32) <= BROADCAST_LIMIT_BYTES:
        settings = F.broadcast(settings)
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names]
    kept = list(dict.fromkeys([*ids, *by]))
    long = current.select(*kept, F.inline(F.array(*rows)))
    renamed = settings.withColumnsRenamed({c: f"_c_{c}" for c in [*by, "metric"]})
    on = F.col("metric") == F.col("_c_metric")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_c_{c}"))
    bound, below = F.col("threshold").cast("double"), F.col("comparison_operator") == BELOW
    broken = F.when(below, F.col("value") < bound).otherwise(F.col("value") > bound)
    compared = long.join(renamed, on).select(
        *kept, "metric", "value", bound.alias("threshold"), "comparison_operator",
        F.coalesce(broken, F.lit(missing == "violated")).alias("violated"),
    )
    return compared.where("violated") if only_violated else compared


def join_ground_truth(
    scored: DataFrame,
    truth: DataFrame,
    max_delay: str = "1 day",
    id: str = "id",
    ts: str = "ts",
    truth_ts: str = "truth_ts",
    latest_only: bool = True,
) -> DataFrame:
    """Scored rows with the ground truth that arrived within ``max_delay`` of them.

    Ids may repeat from run to run, so time is part of the match. A truth row belongs to the latest scored row before it (of
    several at one time to the one that is greatest by its columns); equal truth rows count once. Without ``latest_only`` it is paired
    with every scored row in range. The time axis is cut into pieces of ``max_delay``, and an id that
    is reused millions of times is thereby spread over its pieces and never compared across the whole history. The latest row is found by
    walking both sides of a piece in the order of time: pairs in range, whose number grows with the square of an id's rows, are never made.
    """
    step = F.lit(float(_seconds(max_delay)))
    at, arrived = _epoch(F.col(ts)), _epoch(F.col(truth_ts))
    last = F.floor(arrived / step)
    if latest_only:
        return _latest_before(scored, truth, F.floor(at / step), last, step, id, ts, truth_ts)
    left = scored.withColumn("_piece", F.floor(at / step))
    right = truth.withColumnRenamed(id, "_id").withColumn("_piece_r", F.explode(F.array(last - 1, last)))
    within = (F.col(truth_ts) >= F.col(ts)) & (arrived <= at + step)
    return left.join(
        right, (F.col(id) == F.col("_id")) & (F.col("_piece") == F.col("_piece_r")) & within, "inner"
    ).drop("_piece", "_piece_r", "_id")


def _latest_before(
    scored: DataFrame, truth: DataFrame, piece: Column, truth_piece: Column, step: Column, id: str, ts: str, truth_ts: str
) -> DataFrame:
    """Each distinct truth row with the greatest scored row of its id up to its time, if that is within ``step`` seconds.

    A scored row stands in its own piece of the time axis and in the next one, a truth row in its own; one sort of each (id, piece) by time
    brings a truth row behind all scored rows it can belong to, and the greatest so far is kept in passing.
    """
    others, own = [c for c in truth.columns if c != id], list(scored.columns)
    row = F.struct(F.col(ts).alias("_ts"), F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"))
    runs = scored.select(F.col(id).alias("_id"), F.explode(F.array(piece, piece + 1)).alias("_piece"), _instant(scored, ts).alias("_at"), row.alias("_run"))
    asked = truth.select(
        F.col(id).alias("_id"), truth_piece.alias("_piece"), _instant(truth, truth_ts).alias("_at"),
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("_truth"))
    both = runs.unionByName(asked, allowMissingColumns=True).where("_id IS NOT NULL AND _piece IS NOT NULL")
    order = Window.partitionBy("_id", "_piece").orderBy("_at", "_truth")  # at one time scored rows, without truth, come first
    found = both.select(
        "_truth", F.max("_run").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_last"), F.lag("_truth").over(order).alias("_twin"))
    found = found.where(
        F.col("_truth").isNotNull() & ~F.col("_truth").eqNullSafe(F.col("_twin"))
        & (_epoch(F.col("_truth")[truth_ts]) <= _epoch(F.col("_last._ts")) + step))
    return found.select("_last._row.*", *[F.col("_truth")[c].alias(c) for c in others])


def _instant(df: DataFrame, c: str) -> Column:
    """A column to sort by time: as it is, or made a timestamp."""
    return F.col(c) if df.schema[c].dataType.typeName().startswith("timestamp") else F.col(c).cast("timestamp")


def _epoch(c: Column) -> Column:
    """Seconds since 1970 with fraction, for timestamps with or without a zone."""
    return F.unix_micros(c.cast("timestamp")) / F.lit(1e6)


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _seconds(interval: str) -> int:
    """Seconds of a plain interval such as '600 seconds' or '1 day'."""
    number, unit = interval.split()
    return int(number) * _UNITS[unit.rstrip("s")]


def evaluate_windows(
    joined: DataFrame, every: str = "1 day", by: Sequence[str] = (), threshold: float = 0.5, ts: str = "ts",
    score: str = "probability", label: str = "label",
) -> DataFrame:
    """Full evaluation per tumbling window (and group): (window_start, by…, counts, metrics)."""
    windowed = joined.withColumn("window_start", F.window(ts, every)["start"])
    return evaluate(windowed, threshold, ["window_start", *by], score, label)


def stream_summary(
    df: DataFrame, every: str = "1 day", ts: str = "ts", threshold: float = 0.5, score: str = "probability",
    label: str | None = "label", by: Sequence[str] = (),
) -> DataFrame:
    """Rows, predicted-late rate and actual late rate per window (and group); works on batch and streaming frames."""
    aggregates = [
        F.count("*").alias("n"),
        (F.avg((F.col(score) >= threshold).cast("int")) * 100).alias("predicted_rate"),
    ]
    if label is not None:
        aggregates.append((F.avg((F.col(label) == 1).cast("int")) * 100).alias("delay_rate"))
    return (
        df.groupBy(F.window(ts, every).alias("_w"), *by).agg(*aggregates)
        .select(F.col("_w.start").alias("window_start"), *by, *[F.col(c) for c in ("n", "predicted_rate")],
                *([F.col("delay_rate")] if label is not None else []))
    )


def alarm(
    metrics: DataFrame,
    period_seconds: int = ALARM_PERIOD_SECONDS,
    threshold: float = ALARM_THRESHOLD,
    treat_missing: str = "breaching",
    by: Sequence[str] = (),
    ts: str = "window_start",
    value: str = "f1_score",
) -> DataFrame:
    """Alarm state of every period between the first and last metric of a group.

    A period alarms if its average is at or below the threshold. Periods without data alarm with
    ``treat_missing='breaching'``, do not with ``'notBreaching'``, and have a NULL state with ``'missing'``.
    """
    if treat_missing not in ("breaching", "notBreaching", "missing"):
        raise ValueError(f"unknown treat_missing: {treat_missing}")
    by = list(by)
    period = F.window(ts, f"{period_seconds} seconds")["start"]
    averages = metrics.groupBy(*by, period.alias("period_start")).agg(F.avg(value).alias("average"))
    # each period with data fills the gap up to the next one, so a long gap is no array over the whole time
    after = F.lead("period_start").over(Window.partitionBy(*by).orderBy("period_start"))
    step = F.expr(f"INTERVAL {int(period_seconds)} SECOND")
    last = F.coalesce(after - step, F.col("period_start"))
    spans = averages.select(*by, "average", F.col("period_start").alias("_first"), last.alias("_last"))
    filled = spans.select(*by, "average", F.posexplode(F.sequence("_first", "_last", step)).alias("_place", "period_start"))
    joined = filled.select(*by, "period_start", F.when(F.col("_place") == 0, F.col("average")).alias("average"))
    no_data = {"breaching": F.lit(True), "notBreaching": F.lit(False), "missing": F.lit(None).cast("boolean")}
    return joined.withColumn(
        "in_alarm", F.when(F.col("average").isNull(), no_data[treat_missing]).otherwise(F.col("average") <= threshold)
    )

