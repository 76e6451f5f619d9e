"""Exact binary-classification metrics and curves, for one scored table or for every group of it at once.

Rows are first counted per (group, score) with map-side combine, so a score shared by a third of all rows becomes one
row; everything after that runs on distinct scores, cut into ranges (see ``ranges``). Rows whose score or label is
NULL are left out. ``by`` names the group columns: version, split, segment, window …
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latewatch.functions import ratio_or_zero, safe_ratio
from latewatch.operators.ranges import RANGE, finer, prefix_sums, range_edges, with_range
from latewatch.runtime import pin

METRIC_NAMES = ("accuracy", "precision", "recall", "f1_score", "auc")
# The threshold grid of the sweep and the guard in the F1 of the threshold search.
SWEEP_GRID = (0.3, 0.4, 0.5, 0.6, 0.7)
F1_GUARD = 1e-8

_COUNTS = ("true_negative", "false_positive", "false_negative", "true_positive")


def _usable(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.where(F.col(score).isNotNull() & F.col(label).isNotNull())


def confusion(
    df: DataFrame, threshold: float = 0.5, by: Sequence[str] = (), score: str = "probability", label: str = "label"
) -> DataFrame:
    """Always all four counts, also when only one class occurs."""
    hit, real = F.col(score) >= threshold, F.col(label) == 1
    return _usable(df, score, label).groupBy(*by).agg(
        F.count_if(~hit & ~real).alias("true_negative"),
        F.count_if(hit & ~real).alias("false_positive"),
        F.count_if(~hit & real).alias("false_negative"),
        F.count_if(hit & real).alias("true_positive"),
    )


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """Add accuracy, precision, recall and F1 to confusion counts; an empty denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in _COUNTS)
    return counts.withColumns({
        "accuracy": ratio_or_zero(tn + tp, tn + fp + fn + tp),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1_score": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    })


def binary_metrics(
    df: DataFrame, threshold: float = 0.5, by: Sequence[str] = (), score: str = "probability", label: str = "label"
) -> DataFrame:
    return metrics_from_counts(confusion(df, threshold, by, score, label))


def score_counts(
    df: DataFrame, by: Sequence[str] = (), score: str = "probability", label: str = "label",
    edges: Sequence[float] | None = None, weight: str | None = None,
) -> DataFrame:
    """Positives and negatives per (group, distinct score), with the range number of the score; with ``weight``, a column of whole numbers,
    each row counts that often.

    Without ``edges`` the counts are written first and cut from there, so an expensive input is evaluated once.
    """
    times = F.lit(1) if weight is None else F.col(weight)
    rows = _usable(df, score, label).select(*by, F.col(score).cast("double").alias("_score"), F.col(label).alias("_y"), times.cast("bigint").alias("_times"))
    counts = rows.groupBy(*by, "_score").agg(*[
        F.coalesce(F.sum(F.when(which, F.col("_times"))), F.lit(0)).alias(c) for c, which in (("pos", F.col("_y") == 1), ("neg", F.col("_y") != 1))
    ])
    if edges is None:
        counts = pin(counts)
        edges = range_edges(counts, "_score")
    return with_range(counts, "_score", finer(edges))


def evaluate(
    df: DataFrame, threshold: float = 0.5, by: Sequence[str] = (), score: str = "probability", label: str = "label",
    edges: Sequence[float] | None = None, weight: str | None = None,
) -> DataFrame:
    """Confusion counts, accuracy, precision, recall, F1 and exact AUC per group; with ``weight`` each row counts that often.

    AUC = Σ pos · (negatives below + half the negatives at the same score) / (P · N). The sum is finished per range,
    then ranges are combined from their totals, so no join is needed; NULL when a class is absent.
    """
    by = list(by)
    counts = score_counts(df, by, score, label, edges, weight)
    below = Window.partitionBy(*by, RANGE).orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    hit = F.col("_score") >= threshold
    per_range = (
        counts.withColumn("_below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
        .groupBy(*by, RANGE).agg(
            F.sum(F.col("pos") * (F.col("_below") + F.col("neg") / 2)).alias("_won"),
            F.sum("pos").alias("_p"),
            F.sum("neg").alias("_n"),
            F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("_tp"),
            F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("_fp"),
        )
    )
    lower = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    combined = (
        per_range.withColumn("_lower", F.coalesce(F.sum("_n").over(lower), F.lit(0)))
        .groupBy(*by).agg(
            F.sum(F.col("_won") + F.col("_p").cast("double") * F.col("_lower")).alias("_won"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_p", "_n", "_tp", "_fp")],
        )
    )
    named = combined.select(
        *by,
        (F.col("_n") - F.col("_fp")).alias("true_negative"),
        F.col("_fp").alias("false_positive"),
        (F.col("_p") - F.col("_tp")).alias("false_negative"),
        F.col("_tp").alias("true_positive"),
        safe_ratio("_won", F.col("_p").cast("double") * F.col("_n")).alias("auc"),
    )
    return metrics_from_counts(named).select(*by, *_COUNTS, *METRIC_NAMES)


def evaluate_by(df: DataFrame, by: str | Sequence[str] = "split", threshold: float = 0.5, **columns) -> DataFrame:
    """The full evaluation of every split (or other group) side by side."""
    return evaluate(df, threshold, [by] if isinstance(by, str) else by, **columns)


def roc_auc(
    df: DataFrame, by: Sequence[str] = (), score: str = "probability", label: str = "label",
    edges: Sequence[float] | None = None,
) -> DataFrame:
    return evaluate(df, 0.5, by, score, label, edges).select(*by, "auc")


def _curve(df, by, score, label, edges) -> DataFrame:
    counts = score_counts(df, by, score, label, edges)
    return prefix_sums(counts, "_score", ["pos", "neg"], by, descending=True)


def roc_curve(
    df: DataFrame, by: Sequence[str] = (), score: str = "probability", label: str = "label",
    drop_intermediate: bool = True, edges: Sequence[float] | None = None,
) -> DataFrame:
    """(threshold, fpr, tpr) from the strictest threshold down, starting at (infinity, 0, 0).

    ``drop_intermediate`` leaves out a point whose step equals the next one; the first and last are always kept.
    """
    by = list(by)
    c = _curve(df, by, score, label, edges)
    if drop_intermediate:
        corner = (F.col("pos") != F.col("pos_next")) | (F.col("neg") != F.col("neg_next"))
        last = F.col("pos_next").isNull()
        c = c.where(corner | last | _is_first())
    point = F.struct(
        F.col("_score").alias("threshold"),
        safe_ratio("neg_upto", "neg_all").alias("fpr"),
        safe_ratio("pos_upto", "pos_all").alias("tpr"),
    )
    start = F.struct(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return c.select(*by, F.inline(F.when(_is_first(), F.array(start, point)).otherwise(F.array(point))))


def _is_first() -> Column:
    return F.col("pos_upto") + F.col("neg_upto") == F.col("pos") + F.col("neg")


def _precision_recall(c: DataFrame) -> DataFrame:
    """Precision and recall at each threshold; recall is 1 when there is no positive at all."""
    return c.withColumns({
        "precision": ratio_or_zero("pos_upto", F.col("pos_upto") + F.col("neg_upto")),
        "recall": F.coalesce(safe_ratio("pos_upto", "pos_all"), F.lit(1.0)),
    })


def pr_curve(
    df: DataFrame, by: Sequence[str] = (), score: str = "probability", label: str = "label",
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """(threshold, precision, recall) at every distinct score plus the end point (NULL, 1, 0)."""
    by = list(by)
    c = _precision_recall(_curve(df, by, score, label, edges))
    point = F.struct(F.col("_score").alias("threshold"), F.col("precision"), F.col("recall"))
    end = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return c.select(*by, F.inline(F.when(_is_first(), F.array(end, point)).otherwise(F.array(point))))


def best_threshold(
    df: DataFrame, by: Sequence[str] = (), score: str = "probability", label: str = "label",
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """The threshold with the highest F1 (lowest threshold on a tie) and its precision, recall and F1."""
    by = list(by)
    p, r = F.col("precision"), F.col("recall")
    c = _precision_recall(_curve(df, by, score, label, edges)).withColumn("f1", 2 * (p * r) / (p + r + F.lit(F1_GUARD)))
    best = F.max_by(
        F.struct(F.col("_score").alias("threshold"), "precision", "recall", "f1"), F.struct("f1", -F.col("_score"))
    )
    return c.groupBy(*by).agg(best.alias("_best")).select(*by, "_best.*")


def threshold_sweep(
    df: DataFrame, grid: Sequence[float] = SWEEP_GRID, by: Sequence[str] = (), score: str = "probability",
    label: str = "label",
) -> DataFrame:
    """Precision, recall and F1 for each threshold of a small grid, and which is best (first maximum).

    One pass: the grid becomes conditional counts, rows are never multiplied.
    """
    by = list(by)
    real = F.col(label) == 1
    aggregates = [F.count_if(real).alias("_p")]
    for i, t in enumerate(grid):
        hit = F.col(score) >= float(t)
        aggregates += [F.count_if(hit & real).alias(f"_tp{i}"), F.count_if(hit & ~real).alias(f"_fp{i}")]
    totals = _usable(df, score, label).groupBy(*by).agg(*aggregates)
    rows = []
    for i, t in enumerate(grid):
        tp, fp = F.col(f"_tp{i}"), F.col(f"_fp{i}")
        rows.append(F.struct(
            F.lit(float(t)).alias("threshold"),
            ratio_or_zero(tp, tp + fp).alias("precision"),
            ratio_or_zero(tp, "_p").alias("recall"),
            ratio_or_zero(2 * tp, tp + fp + F.col("_p")).alias("f1"),
        ))
    listed = totals.select(*by, F.array(*rows).alias("_rows"))
    top = F.array_max(F.transform("_rows", lambda r: F.struct(r["f1"], (-r["threshold"]).alias("t"))))
    listed = listed.withColumn("_top", -top["t"]).select(*by, "_top", F.inline("_rows"))
    return listed.select(*by, "threshold", "precision", "recall", "f1", (F.col("threshold") == F.col("_top")).alias("is_best"))


def compare_models(
    df: DataFrame, version: str = "version", threshold: float = 0.5, by: Sequence[str] = (), **columns
) -> DataFrame:
    """One row per version with all metrics."""
    return evaluate(df, threshold, [*by, version], **columns)


def best_per_metric(
    metrics: DataFrame, version: str = "version", names: Sequence[str] = ("auc", "precision", "recall", "f1_score"),
    by: Sequence[str] = (),
) -> DataFrame:
    """For each metric the best version (lowest version on a tie): (metric, version, value)."""
    long = unpivot_metrics(metrics, [*by, version], names).where("value IS NOT NULL")
    best = long.groupBy(*by, "metric").agg(F.min(F.struct((-F.col("value")).alias("_minus"), F.col(version), F.col("value"))).alias("_best"))
    return best.select(*by, "metric", F.col("_best")[version].alias(version), F.col("_best.value").alias("value"))


def unpivot_metrics(metrics: DataFrame, ids: Sequence[str], names: Sequence[str] = METRIC_NAMES) -> DataFrame:
    """Wide metrics to rows (ids…, metric, value)."""
    return metrics.unpivot(
        [F.col(c) for c in ids], [F.col(n).cast("double").alias(n) for n in names], "metric", "value"
    )


def evaluation_report(evaluated: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Nested report of an evaluation: ``metrics.<name>.value`` and ``confusion_matrix.<count>``."""
    values = [F.struct(F.col(n).alias("value")).alias(n) for n in METRIC_NAMES]
    return evaluated.select(
        *by, F.struct(*values).alias("metrics"), F.struct(*[F.col(c) for c in _COUNTS]).alias("confusion_matrix")
    )


def metric(name: str, report: str | None = None) -> Column:
    """One metric of a report: a nested column, or a path into a JSON text column."""
    if report is None:
        return F.col(f"metrics.{name}.value")
    return F.get_json_object(F.col(report), f"$.metrics.{name}.value").cast("double")
