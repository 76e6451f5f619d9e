"""Regularised boosting against a plain version, AUC patience against a plain loop, presets, odd values, saving."""

import math
import random
import warnings

import pytest
from pyspark.sql import functions as F

from conftest import rows
from latewatch.operators import boosting as bo
from latewatch.operators import metrics as mt
from latewatch.operators import model as ml

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def raw():
    rng = random.Random(3)
    out = []
    for i in range(900):
        a, b, c = rng.randrange(12), rng.choice([0.5, 1.5, None, 4.0]), rng.randrange(2)
        p = 1 / (1 + math.exp(-(0.4 * a - 2 + (1.2 if b == 4.0 else 0) - 0.8 * c)))
        out.append((float(a), b, c, int(rng.random() < p), i % 4 == 0))
    return out


@pytest.fixture(scope="module")
def data(spark, raw):
    return spark.createDataFrame(raw, "a double, b double, c int, DELAYED int, is_val boolean").repartition(4)


class Plain:
    """Exact greedy boosting over all distinct values, in plain loops; missing values go right."""

    def __init__(self, table, rounds, depth, eta, alpha, reg, gamma, least, weight):
        self.p = (eta, alpha, reg, gamma, least)
        self.trees, margin = [], [0.0] * len(table)
        for _ in range(rounds):
            g, h = [], []
            for m, (*_, y) in zip(margin, table):
                p, w = 1 / (1 + math.exp(-m)), weight if y else 1.0
                g.append(w * (p - y))
                h.append(w * p * (1 - p))
            tree = self.grow(table, g, h, list(range(len(table))), depth)
            self.trees.append(tree)
            margin = [m + self.leaf(tree, r) for m, r in zip(margin, table)]
        self.margin = margin

    def shrunk(self, g):
        return math.copysign(max(abs(g) - self.p[1], 0.0), g)

    def worth(self, g, h):
        return self.shrunk(g) ** 2 / (h + self.p[2])

    def grow(self, table, g, h, at, depth):
        eta, _, reg, gamma, least = self.p
        G, H = sum(g[i] for i in at), sum(h[i] for i in at)
        best = None
        if depth:
            for f in range(len(table[0]) - 1):
                values = sorted({table[i][f] for i in at if table[i][f] is not None})
                right_too = any(table[i][f] is None for i in at)
                for v in values if right_too else values[:-1]:
                    left = [i for i in at if table[i][f] is not None and table[i][f] <= v]
                    lg, lh = sum(g[i] for i in left), sum(h[i] for i in left)
                    gain = self.worth(lg, lh) + self.worth(G - lg, H - lh) - self.worth(G, H)
                    if gain > gamma and lh >= least and H - lh >= least and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, v, left)
        if best is None:
            return -eta * self.shrunk(G) / (H + reg)
        left = set(best[3])
        return best[1], best[2], self.grow(table, g, h, best[3], depth - 1), self.grow(table, g, h, [i for i in at if i not in left], depth - 1)

    def leaf(self, tree, row):
        while isinstance(tree, tuple):
            f, v, left, right = tree
            tree = left if row[f] is not None and row[f] <= v else right
        return tree


@pytest.mark.parametrize("options", [
    {"max_depth": 1, "num_round": 3, "eta": 0.5, "reg_lambda": 0.0, "reg_alpha": 0.0, "gamma": 0.0, "min_child_weight": 0, "scale_pos_weight": 1.0},
    {"max_depth": 3, "num_round": 3, "eta": 0.3, "reg_lambda": 2.0, "reg_alpha": 1.5, "gamma": 0.3, "min_child_weight": 5, "scale_pos_weight": 3.0},
    {"max_depth": 4, "num_round": 3, "eta": 0.4, "reg_lambda": 1.0, "reg_alpha": 0.0, "gamma": 2.0, "min_child_weight": 1, "scale_pos_weight": 2.0},
])
def test_equals_plain_boosting(data, raw, options):
    model = bo.train_boosted(data, FEATURES, subsample=1.0, colsample_bytree=1.0, **options)
    plain = Plain([(a, b, c, y) for a, b, c, y, _ in raw], options["num_round"], options["max_depth"], options["eta"], options["reg_alpha"],
                  options["reg_lambda"], options["gamma"], options["min_child_weight"], options["scale_pos_weight"])
    got = {(r.a, r.b, r.c): r.probability for r in bo.score_boosted(model, data).collect()}
    want = {(r[0], r[1], r[2]): 1 / (1 + math.exp(-m)) for r, m in zip(raw, plain.margin)}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert len(model.trees) == options["num_round"]


def test_terms_do_what_they_say(data):
    options = {"num_round": 1, "max_depth": 4, "subsample": 1.0, "colsample_bytree": 1.0, "eta": 1.0, "scale_pos_weight": 1.0}
    leaves = lambda **more: [n for n in bo.train_boosted(data, FEATURES, **options, **more).trees[0] if n.feature < 0]
    free = leaves(reg_lambda=0.0, min_child_weight=0)
    assert len(leaves(reg_lambda=0.0, min_child_weight=0, gamma=20.0)) < len(free)
    assert min(n.cover for n in leaves(min_child_weight=20)) >= 20 > min(n.cover for n in free)
    assert max(abs(n.value) for n in leaves(reg_lambda=50.0)) < max(abs(n.value) for n in free)
    assert [n.value for n in leaves(reg_alpha=1e6)] == [0.0]


def test_columns_and_rows_are_drawn(data):
    model = bo.train_boosted(data, FEATURES, num_round=6, max_depth=1, colsample_bytree=0.34, subsample=0.5, seed=5)
    used = [{n.feature for n in t if n.feature >= 0} for t in model.trees]
    assert all(len(u) <= 1 for u in used) and len(set().union(*used)) == 3
    again = bo.train_boosted(data, FEATURES, num_round=6, max_depth=1, colsample_bytree=0.34, subsample=0.5, seed=5)
    assert [[(n.feature, n.bin) for n in t] for t in again.trees] == [[(n.feature, n.bin) for n in t] for t in model.trees]
    whole = bo.train_boosted(data, FEATURES, num_round=1, max_depth=1, subsample=1.0, colsample_bytree=1.0).trees[0][0].cover
    assert 0.4 < bo.train_boosted(data, FEATURES, num_round=1, max_depth=1, subsample=0.5, colsample_bytree=1.0).trees[0][0].cover / whole < 0.6


def test_patience_on_auc(data, monkeypatch):
    """One fit; the chosen round is that of a plain loop over the AUC of every prefix of the model, whatever the block."""
    options = {"max_depth": 4, "eta": 0.8, "subsample": 1.0, "colsample_bytree": 1.0, "reg_lambda": 0.0, "min_child_weight": 0, "val_flag": "is_val", "seed": 1}
    whole = bo.train_boosted(data, FEATURES, num_round=7, **options)
    held = data.where("is_val")
    plain = [mt.roc_auc(bo.score_boosted(whole.first(k), held), label="DELAYED").first().auc for k in range(1, 8)]
    assert list(whole.auc) == pytest.approx(plain) and len(whole.trees) == 7
    for patience in (1, 3):
        best = stop = 0
        for k, x in enumerate(plain):
            if x > plain[best]:
                best = k
            elif k - best >= patience:
                stop = k
                break
        monkeypatch.setattr(bo, "BLOCK", 2 if patience == 1 else 4)
        stopped = bo.train_boosted(data, FEATURES, num_round=7, early_stopping_rounds=patience, **options)
        assert len(stopped.trees) == best + 1 and (stop or patience == 3)  # the data are small and the trees are deep: it stops
        assert bo.score_boosted(stopped, held).agg(F.sum("probability")).first()[0] == pytest.approx(
            bo.score_boosted(whole.first(best + 1), held).agg(F.sum("probability")).first()[0])


def test_all_presets_train_without_a_warning(data):
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        for name in ml.PARAMS:
            depth = min(2, ml.PARAMS[name]["max_depth"])
            model = bo.train_boosted(data, FEATURES, preset=name, val_flag="is_val", num_round=2, max_depth=depth)
            assert 1 <= len(model.trees) <= 2 and len(model.auc) == 2
    assert ml.resolve_params("smoothed", regularised=True)["reg_alpha"] == 0.1
    with pytest.raises(ValueError):
        bo.train_boosted(data, FEATURES, nonsense=1)


def test_many_values_and_ranking(spark):
    """Far more values than bins: ranks almost as well as the cause itself."""
    df = spark.range(4000).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100_000).alias("a"), (F.col("id") % 5).cast("double").alias("b")
    ).withColumn("DELAYED", (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000 < F.col("a")).cast("int"))
    model = bo.train_boosted(df, ["a", "b"], num_round=6, max_depth=3, eta=0.5, subsample=1.0, colsample_bytree=1.0)
    best = mt.roc_auc(df, score="a", label="DELAYED").first().auc
    assert mt.roc_auc(bo.score_boosted(model, df), label="DELAYED").first().auc > best - 0.01
    top = bo.gain_importances(model, spark, 1).collect()
    assert top[0].feature == "a" and sum(model.gains().values()) == pytest.approx(1.0)


def test_odd_inputs(spark, data, tmp_path):
    model = bo.train_boosted(data, FEATURES, num_round=2, max_depth=2, seed=1)
    model.save(spark, str(tmp_path / "m"))
    again = bo.BoostedTrees.load(spark, str(tmp_path / "m"))
    odd = spark.createDataFrame([(math.nan, None, None, "x"), (None, math.inf, 1, "y"), (1e300, -math.inf, 0, "z")], "a double, b double, c int, probability string")
    scored = bo.score_boosted(model, odd)
    assert rows(scored.select("probability")) == rows(bo.score_boosted(again, odd).select("probability")) and scored.count() == 3
    assert all(0 < r.probability < 1 for r in scored.collect())
    both = bo.score_boosted(model, odd.unionByName(data.limit(200).selectExpr("a", "b", "c", "'p' AS probability")).drop("probability"), expression_nodes=0)
    assert "CASE WHEN" in both._jdf.queryExecution().optimizedPlan().toString() and "aggregate(" in both._jdf.queryExecution().optimizedPlan().toString()
    direct = bo.score_boosted(model, both.drop("prediction").withColumnRenamed("probability", "other"))
    assert direct.where("other = probability").count() == direct.count() == 203
    with_gaps = data.withColumn("DELAYED", F.when(F.col("a") > 3, F.col("DELAYED"))).withColumn("k", F.lit(1.0))
    assert bo.train_boosted(with_gaps, [*FEATURES, "k"], num_round=1).trees
    for nothing in (data.limit(0), data.where("DELAYED = 1")):
        empty = bo.train_boosted(nothing, FEATURES)
        assert empty.trees == () and {r.probability for r in bo.score_boosted(empty, data.limit(5)).collect()} == {0.5}
    no_class = bo.train_boosted(data.withColumn("is_val", F.col("is_val") & (F.col("DELAYED") == 1)), FEATURES, val_flag="is_val", num_round=2, early_stopping_rounds=1)
    assert no_class.auc == () and len(no_class.trees) == 2
    with pytest.raises(ValueError):
        bo.train_boosted(data.withColumn("s", F.lit("x")), ["a", "s"])
