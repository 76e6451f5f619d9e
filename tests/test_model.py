"""Parameter handling and the tree learner on data with a learnable pattern."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from latewatch.operators import metrics as mt
from latewatch.operators import model as ml

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def data(spark):
    draw = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    return spark.range(2000).select(
        "id", (F.col("id") % 50).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), draw.alias("u"),
    ).select("id", "a", "b", (F.col("u") < F.col("a") / 50).cast("int").alias("DELAYED"), (F.col("id") % 5 == 0).alias("is_val"))


@pytest.fixture(scope="module")
def model(data):
    return ml.train_gbt(data, FEATURES, preset="baseline", val_flag="is_val", seed=1, max_depth=2)


def test_merge_order():
    assert ml.resolve_params()["max_depth"] == 6
    assert ml.resolve_params("baseline")["max_depth"] == 1
    p = ml.resolve_params("baseline", {"max_depth": 8, "learning_rate": 0.2, "n_estimators": 200, "objective": "binary:logistic"})
    assert (p["max_depth"], p["eta"], p["num_round"]) == (8, 0.2, 200)


@pytest.mark.parametrize("bad", [{"reg_lambda": 1.0}, {"reg_alpha": 0.1}, {"nonsense": 1}, {"objective": "multi:softmax"}])
def test_bad_parameters_are_refused(bad):
    with pytest.raises(ValueError):
        ml.resolve_params(None, bad)


def test_every_preset_maps_to_the_learner(spark):
    for name in ml.PARAMS:
        gbt = ml.gbt_pipeline(FEATURES, "y", ml.resolve_params(name), "w", "v").getStages()[1]
        assert gbt.getMaxIter() == ml.PARAMS[name]["num_round"]
        assert gbt.getStepSize() == ml.PARAMS[name]["eta"]
        assert gbt.getMaxDepth() == ml.PARAMS[name]["max_depth"]


def test_presets_say_what_they_leave_out(data):
    with pytest.warns(UserWarning, match="reg_lambda"):
        notebook = ml.resolve_params("notebook")
    with pytest.warns(UserWarning, match="reg_alpha"):
        smoothed = ml.resolve_params("smoothed")
    negatives, positives = (data.where(f"DELAYED = {k}").count() for k in (0, 1))
    skewed = data.where("DELAYED = 0").union(data.where("DELAYED = 1").limit(100))
    assert ml.class_weight(data, notebook) == pytest.approx(negatives / positives)
    assert ml.class_weight(skewed, notebook) == pytest.approx(negatives / 100) and ml.class_weight(skewed, smoothed) == 3.0
    assert ml.class_weight(data.where("DELAYED = 0"), notebook) == 1.0 and ml.class_weight(data, ml.resolve_params("baseline")) == 5.5


def test_patience():
    losses = [1.0, 0.8, 0.9, 0.85, 0.7, 0.75, 0.72, 0.71, 0.6]
    assert [ml.stopping_round(losses, k) for k in (1, 2, 3, 4)] == [2, 2, 5, 9]
    assert ml.stopping_round([1.0], 3) == 1


def test_early_stopping_keeps_the_best_round(data):
    options = {"num_round": 8, "max_depth": 5, "eta": 0.9, "seed": 1, "subsample": 1.0, "colsample_bytree": 1.0, "scale_pos_weight": 1.0}
    whole = ml.train_gbt(data.where("NOT is_val"), FEATURES, **options)
    held = data.where("is_val").select("a", "b", F.col("DELAYED").cast("double").alias("DELAYED"), F.lit(1.0).alias("_weight"))
    losses = whole.stages[-1].evaluateEachIteration(whole.stages[0].transform(held))
    stopped = ml.train_gbt(data, FEATURES, val_flag="is_val", early_stopping_rounds=2, **options)
    assert stopped.stages[-1].getNumTrees == ml.stopping_round(losses, 2) < 8


def test_learns_scores_and_is_reproducible(data, model):
    scored = ml.score(model, data)
    assert scored.count() == data.count()
    assert set(scored.columns) == {*data.columns, "probability", "prediction"}
    assert mt.roc_auc(scored, label="DELAYED").first().auc > 0.7  # ten rough rounds, stopped early
    again = ml.train_gbt(data, FEATURES, preset="baseline", val_flag="is_val", seed=1, max_depth=2)
    assert rows(ml.score(again, data).select("id", "probability")) == rows(scored.select("id", "probability"))


def test_approaches_the_best_possible_auc(data):
    """The label is drawn with chance a / 50, so ranking by ``a`` itself is the best any model can do."""
    best = mt.roc_auc(data, score="a", label="DELAYED").first().auc
    strong = ml.score(ml.train_gbt(data, FEATURES, num_round=15, max_depth=4, eta=0.3, seed=1), data)
    assert mt.roc_auc(strong, label="DELAYED").first().auc > best - 0.02


def test_importances_rank_the_real_cause_first(data, model):
    r = ml.importances(model, FEATURES, data).collect()
    assert r[0].feature == "a" and sum(x.importance for x in r) == pytest.approx(1.0)
    assert ml.importances(model, FEATURES, data, top=1).count() == 1


def test_class_weight_raises_probabilities(data):
    light, heavy = (
        ml.score(ml.train_gbt(data, FEATURES, num_round=3, max_depth=2, seed=1, scale_pos_weight=w), data)
        .agg(F.avg("probability")).first()[0] for w in (1.0, 8.0)
    )
    assert heavy > light


def test_save_and_load(data, model, tmp_path):
    ml.save(model, str(tmp_path / "m"))
    assert rows(ml.score(ml.load(str(tmp_path / "m")), data.limit(50)).select("probability")) == rows(
        ml.score(model, data.limit(50)).select("probability"))


def test_non_numeric_features_are_refused(data):
    with pytest.raises(ValueError, match="s"):
        ml.train_gbt(data.withColumn("s", F.lit("x")), ["a", "s"])


def test_parts_of_the_rows_do_not_grow_with_them(spark):
    for n, parts in ((10, 2), (1000, 20), (4000, 80)):
        df = spark.range(n).select("id", (F.col("id") * 2).alias("b"))
        dealt = ml.even_parts(df, 2, cells=100)
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert dealt.rdd.getNumPartitions() == parts and max(sizes) <= 60 and sum(sizes) == n
