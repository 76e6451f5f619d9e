"""Quality gate, rejection reports and latest-version lookup, over tables of model runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits and wording of the gate, the diagnosis and the recommendations.
F1_THRESHOLD = 0.20
POOR_F1 = 0.10
LOW_PRECISION = 0.15
LOW_RECALL = 0.20
REJECTION_REASON = "Model performance below threshold"
REJECTED = "REJECTED"
DIAGNOSES = {
    "poor": "Extremely poor performance - model may be predicting all one class",
    "precision": "Low precision - too many false positives",
    "recall": "Low recall - missing too many delays",
    "close": "Model performance is close but not quite meeting threshold",
}
NEXT_STEPS = {
    "poor": "Check class balancing (scale_pos_weight parameter)",
    "precision": "Consider increasing decision threshold or improving features",
    "recall": "Model is too conservative, consider class balancing",
    "close": "Fine-tuning hyperparameters may help",
}
ADVICE_POOR = (
    "Add class balancing: Set scale_pos_weight to handle class imbalance",
    "Verify target variable is correct",
    "Check if model is predicting all one class",
)
ADVICE_FEATURES = (
    "Review feature engineering - add domain-specific features",
    "Add target-encoded features (historical delay rates)",
    "Add volume-based features (flight frequency metrics)",
)
ADVICE_ALWAYS = (
    "Increase model complexity (deeper trees, more rounds)",
    "Tune learning rate for better convergence",
    "Collect more training data if available",
)


def quality_gate(metrics: DataFrame, threshold: float = F1_THRESHOLD, f1: str = "f1_score") -> DataFrame:
    """Add ``passed``: F1 at or above the threshold; a missing F1 fails."""
    return metrics.withColumn("passed", F.coalesce(F.col(f1) >= F.lit(threshold), F.lit(False)))


def _is_poor() -> Column:
    return F.col("f1_score") < POOR_F1


def diagnose(metrics: DataFrame) -> DataFrame:
    """Add ``diagnosis`` and ``next_step``: of the first of poor F1, low precision, low recall, else close."""

    def text(of: dict[str, str]) -> Column:
        return (
            F.when(_is_poor(), of["poor"]).when(F.col("precision") < LOW_PRECISION, of["precision"])
            .when(F.col("recall") < LOW_RECALL, of["recall"]).otherwise(of["close"])
        )

    return metrics.withColumns({"diagnosis": text(DIAGNOSES), "next_step": text(NEXT_STEPS)})


def recommend(metrics: DataFrame) -> DataFrame:
    """Add ``recommendations``: the advice lists that apply, in order, as one array."""

    def texts(items: Sequence[str]) -> Column:
        return F.array(*[F.lit(t) for t in items])

    none = F.array().cast("array<string>")
    weak = (F.col("precision") < LOW_PRECISION) | (F.col("recall") < LOW_RECALL)
    return metrics.withColumn(
        "recommendations",
        F.concat(
            F.when(_is_poor(), texts(ADVICE_POOR)).otherwise(none),
            F.when(weak, texts(ADVICE_FEATURES)).otherwise(none),
            texts(ADVICE_ALWAYS),
        ),
    )


def rejection_report(
    metrics: DataFrame, threshold: float = F1_THRESHOLD, by: Sequence[str] = (), at: Column | None = None
) -> DataFrame:
    """One nested rejection record per run that fails the gate."""
    at = F.current_timestamp() if at is None else at
    failed = recommend(quality_gate(metrics, threshold).where(~F.col("passed")))
    required = F.lit(float(threshold))
    return failed.select(
        *by,
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("rejection_timestamp"),
        F.lit(REJECTION_REASON).alias("rejection_reason"),
        F.struct(
            F.lit("f1_score").alias("metric"), required.alias("required"), F.col("f1_score").alias("actual"),
            (required - F.col("f1_score")).alias("gap"),
        ).alias("threshold"),
        F.struct("f1_score", "precision", "recall", "auc").alias("model_metrics"),
        F.lit(REJECTED).alias("status"),
        "recommendations",
    )


def latest_by(
    df: DataFrame, group: Sequence[str], order: Sequence[str], where: Column | str | None = None
) -> DataFrame:
    """The latest row of each group among those that satisfy ``where``.

    A ``max_by`` with map-side combine: a hot group is reduced before it is shuffled, unlike a ranked window.
    """
    if where is not None:
        df = df.where(where)
    newest = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*group).agg(newest.alias("_row")).select("_row.*")
