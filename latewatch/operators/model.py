"""Boosted-tree classifier: parameter sets, training, scoring, importances. Training is Spark ML's distributed GBT."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latewatch.functions import classify
from latewatch.operators.matrix import assert_numeric
from latewatch.operators.profile import pos_weight
from latewatch.runtime import shared_dir

# Default parameters and the named experiments.
DEFAULTS: dict[str, object] = {
    "max_depth": 6, "eta": 0.1, "num_round": 100, "subsample": 0.8, "colsample_bytree": 0.8,
    "scale_pos_weight": 5.5, "min_child_weight": 1,
}
PARAMS: dict[str, dict[str, object]] = {
    "baseline": {
        "max_depth": 1, "eta": 0.9, "num_round": 10, "subsample": 0.4, "colsample_bytree": 0.4,
        "scale_pos_weight": 5.5, "min_child_weight": 20,
    },
    "improved": {
        "max_depth": 6, "eta": 0.1, "num_round": 100, "subsample": 0.8, "colsample_bytree": 0.8,
        "scale_pos_weight": 5.5, "min_child_weight": 1,
    },
    "raw_benchmark": {
        "max_depth": 8, "eta": 0.1, "num_round": 500, "subsample": 0.8, "colsample_bytree": 0.8,
        "scale_pos_weight": 4.58, "early_stopping_rounds": 30,
    },
    "engineered": {
        "max_depth": 8, "eta": 0.05, "num_round": 1000, "subsample": 0.8, "colsample_bytree": 0.8,
        "scale_pos_weight": 4.58, "early_stopping_rounds": 50,
    },
    "notebook": {
        "max_depth": 8, "eta": 0.1, "num_round": 500, "subsample": 0.8, "colsample_bytree": 0.8, "scale_pos_weight": "auto",
        "min_child_weight": 1, "gamma": 0, "reg_lambda": 1.0, "seed": 42, "early_stopping_rounds": 30,
    },
    "smoothed": {
        "max_depth": 6, "eta": 0.03, "num_round": 1000, "subsample": 0.8, "colsample_bytree": 0.8, "scale_pos_weight": "auto",
        "pos_weight_cap": 3.0, "min_child_weight": 5, "gamma": 0.3, "reg_alpha": 0.1, "reg_lambda": 2.0, "seed": 42,
        "early_stopping_rounds": 50,
    },
}
# Which feature list an experiment trains on.
EXPERIMENT_FEATURES = {
    "baseline": "basic", "improved": "full", "raw_benchmark": "raw", "engineered": "no_target_encoding",
    "notebook": "full", "smoothed": "smoothed",
}

_ALIASES = {"learning_rate": "eta", "n_estimators": "num_round", "random_state": "seed"}
_TO_GBT = {
    "max_depth": "maxDepth", "eta": "stepSize", "num_round": "maxIter", "subsample": "subsamplingRate",
    "min_child_weight": "minInstancesPerNode", "gamma": "minInfoGain", "seed": "seed",
}
_HANDLED = {*_TO_GBT, "colsample_bytree", "scale_pos_weight", "pos_weight_cap", "early_stopping_rounds"}
_IMPLIED = {"objective": "binary:logistic", "eval_metric": "auc"}
_SPARK_ML = {"maxBins", "maxMemoryInMB", "checkpointInterval", "validationTol", "cacheNodeIds"}
_NO_EQUIVALENT = {"reg_alpha", "reg_lambda"}


def resolve_params(
    preset: str | None = None, overrides: Mapping[str, object] | None = None, regularised: bool = False
) -> dict[str, object]:
    """Defaults, then the preset, then the overrides. Unknown names are refused. Terms of a preset that the Spark ML tree learner has no
    equivalent for are left out with a warning, and as overrides refused, unless the learner is a ``regularised`` one, which has them all."""
    merged = dict(DEFAULTS)
    for layer in (PARAMS[preset] if preset else {}, overrides or {}):
        for name, value in layer.items():
            name = _ALIASES.get(name, name)
            if name in _NO_EQUIVALENT and regularised:
                merged[name] = value
                continue
            if name in _NO_EQUIVALENT and layer is not overrides:
                warnings.warn(f"{preset}: {name}={value} has no equivalent in the Spark ML tree learner and is left out", stacklevel=2)
                continue
            if name in _NO_EQUIVALENT:
                raise ValueError(f"{name} has no equivalent in the Spark ML tree learner")
            if name in _IMPLIED:
                if value != _IMPLIED[name]:
                    raise ValueError(f"{name} can only be {_IMPLIED[name]}")
                continue
            if name not in _HANDLED | _SPARK_ML:
                raise ValueError(f"unknown parameter: {name}")
            merged[name] = value
    return merged


def class_weight(df: DataFrame, params: Mapping[str, object], label: str = "DELAYED") -> float:
    """The weight of positives: as given, or for ``auto`` negatives / positives of ``df``, at most ``pos_weight_cap``. Without
    positives it is 1."""
    if params["scale_pos_weight"] != "auto":
        return float(params["scale_pos_weight"])
    measured = pos_weight(df, label, params.get("pos_weight_cap")).first()["pos_weight"]
    return 1.0 if measured is None else float(measured)


def stopping_round(losses: Sequence[float], patience: int) -> int:
    """Rounds to keep: the best one before ``patience`` rounds without a gain."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def gbt_pipeline(
    features: Sequence[str], label: str, params: Mapping[str, object], weight: str, val_flag: str | None = None
) -> Pipeline:
    options = {_TO_GBT[k]: v for k, v in params.items() if k in _TO_GBT}
    options |= {k: v for k, v in params.items() if k in _SPARK_ML}
    options["minInstancesPerNode"] = max(1, int(options.get("minInstancesPerNode", 1)))
    if "colsample_bytree" in params:  # per tree node here, not per tree
        options["featureSubsetStrategy"] = str(float(params["colsample_bytree"]))
    if val_flag is not None:
        options["validationIndicatorCol"] = val_flag
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="error")
    gbt = GBTClassifier(featuresCol="_features", labelCol=label, weightCol=weight, **options)
    return Pipeline(stages=[assembler, gbt])


# Values in one part of the rows trained on: 64 MB of doubles.
PARTITION_CELLS = 8_000_000


def even_parts(rows: DataFrame, partitions: int, cells: int = PARTITION_CELLS) -> DataFrame:
    """The rows dealt into ``partitions`` even parts, or into more, so that none has above about ``cells`` values whatever the number of rows."""
    return rows.repartition(max(partitions, math.ceil(rows.count() * len(rows.columns) / cells)))


def train_gbt(
    df: DataFrame,
    features: Sequence[str],
    label: str = "DELAYED",
    preset: str | None = None,
    val_flag: str | None = None,
    partitions: int | None = None,
    **overrides: object,
) -> PipelineModel:
    """Train on ``df``. Positives weigh ``scale_pos_weight``; ``auto`` measures it on the rows trained on.

    Boosting passes over the rows many times, so rows that come in few or uneven partitions are worth one round-robin
    shuffle into ``partitions`` even parts first, or into more parts if these grow large. The order of rows then may differ between runs, and with it sampling.

    Rows whose boolean ``val_flag`` is true are not trained on. With ``early_stopping_rounds`` all rounds are boosted, the loss on those
    rows is measured after each, and the model is fitted again with the rounds up to the best one before that many
    rounds without a gain. Without it, boosting stops at the first round without a gain (Spark's own rule).
    """
    params = resolve_params(preset, overrides)
    shared_dir(df.sparkSession)  # boosting cuts its own lineage there
    columns = [F.col(c) for c in features]
    assert_numeric(df.select(*columns))
    trained_on = df.where(~F.col(val_flag)) if val_flag else df
    weight = F.when(F.col(label) == 1, F.lit(class_weight(trained_on, params, label))).otherwise(F.lit(1.0))
    flag = [F.col(val_flag)] if val_flag else []
    rows = df.select(*columns, F.col(label).cast(T.DoubleType()).alias(label), weight.alias("_weight"), *flag)
    if partitions is not None:
        rows = even_parts(rows, partitions)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # metadata, training and validation passes all read them
    try:
        patience = params.get("early_stopping_rounds")
        if val_flag is None or not patience:
            return gbt_pipeline(features, label, params, "_weight", val_flag).fit(rows)
        fitting, held = rows.where(~F.col(val_flag)), rows.where(val_flag)
        whole = gbt_pipeline(features, label, params, "_weight").fit(fitting)
        losses = whole.stages[-1].evaluateEachIteration(whole.stages[0].transform(held))
        best = stopping_round(losses, int(patience))
        if best == len(losses):
            return whole
        return gbt_pipeline(features, label, {**params, "num_round": best}, "_weight").fit(fitting)
    finally:
        rows.unpersist()


def score(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Every input row with its probability of class 1 and the class at ``threshold``; runs on streams too."""
    scored = model.transform(df).withColumn("probability", vector_to_array("probability")[1])
    return scored.withColumn("prediction", classify("probability", threshold)).drop("_features", "rawPrediction")


def importances(model: PipelineModel, features: Sequence[str], df: DataFrame, top: int | None = None) -> DataFrame:
    """Features by importance, highest first; one row per feature. ``df`` only lends its session."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(features, values)]
    ranked = df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
    return ranked if top is None else ranked.limit(top)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
