"""Regularised boosting of trees for a 0/1 label, with Spark doing all passes over the rows.

Features are cut into at most ``max_bins`` bins at quantiles of the training rows, once; the binned rows are written. A level of a tree is one aggregate: first and second
derivatives of the log-loss, summed per (node, feature, bin) with map-side combine, prefix sums over the bins, and the best split of each node. Only that
one row per open node reaches the driver. A row's node and margin are expressions over its bins, so rows never move; margins are cut from their
lineage every ``BLOCK`` trees.

Gain of a split, weight of a leaf (G, H: sums of derivatives, a: L1, l: L2):  T(G)² / (H + l) left + right - parent,  -T(G) / (H + l), where
T moves G towards 0 by a. A split needs a gain above ``gamma`` and at least ``min_child_weight`` of H on both sides; of equal gains the first feature,
then the lowest bin wins. Missing and not-a-number values go right. Each tree looks at a drawn share of the features
(``colsample_bytree``) and rows (``subsample``, by a hash of the row's number).

With validation rows and ``early_stopping_rounds`` the margins of all rounds of a block come out of one pass, the exact AUC of every round out of one
grouped evaluation, and the model is the first trees up to the best round: nothing is trained twice.
"""

from __future__ import annotations

import json
import math
import random
import sys
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from latewatch.functions import classify
from latewatch.operators.matrix import assert_numeric
from latewatch.operators.metrics import evaluate
from latewatch.operators.model import class_weight, resolve_params
from latewatch.runtime import pin

# Trees after which margins are written, and validation rows are looked at.
BLOCK = 8
MAX_BINS = 64
# Nodes up to which a model is scored by conditionals.
EXPRESSION_NODES = 1_000


@dataclass(frozen=True)
class Node:
    """A leaf (``feature`` -1) with its weight, or a split: rows with feature <= ``threshold`` go to ``left``, others to ``left`` + 1."""

    value: float
    cover: float
    feature: int = -1
    bin: int = -1
    threshold: float = math.nan
    left: int = -1
    gain: float = 0.0


@dataclass(frozen=True)
class BoostedTrees:
    """Trees over ``features``; the margin is the sum of their leaves. ``auc`` holds the validation AUC of each round that was measured."""

    features: tuple[str, ...]
    trees: tuple[tuple[Node, ...], ...]
    auc: tuple[float, ...] = ()

    def first(self, k: int) -> BoostedTrees:
        return BoostedTrees(self.features, self.trees[:k], self.auc)

    def gains(self) -> dict[str, float]:
        """Total gain per feature, as shares of all gain."""
        total = dict.fromkeys(self.features, 0.0)
        for tree in self.trees:
            for n in tree:
                if n.feature >= 0:
                    total[self.features[n.feature]] += n.gain
        whole = sum(total.values())
        return {f: g / whole if whole else 0.0 for f, g in total.items()}

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps({"features": self.features, "trees": [[asdict(n) for n in t] for t in self.trees], "auc": self.auc})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        raw = json.loads(spark.read.text(path, wholetext=True).first()[0])
        return cls(tuple(raw["features"]), tuple(tuple(Node(**n) for n in t) for t in raw["trees"]), tuple(raw["auc"]))


def _shrunk(g: Column, alpha: float) -> Column:
    return F.signum(g) * F.greatest(F.abs(g) - alpha, F.lit(0.0)) if alpha else g


def _worth(g: Column, h: Column, alpha: float, reg: float) -> Column:
    t = _shrunk(g, alpha)
    return F.when(h + reg > 0, t * t / (h + reg)).otherwise(0.0)


def _leaf(g: float, h: float, p: Mapping[str, float]) -> float:
    t = math.copysign(max(abs(g) - p["reg_alpha"], 0.0), g)
    return -p["eta"] * t / (h + p["reg_lambda"]) if h + p["reg_lambda"] > 0 else 0.0


def _walk(tree: Sequence[Node], end, at: int = 0) -> Column:
    """The tree over the column ``_bins``; ``end`` makes the value of a leaf from its place."""
    n = tree[at]
    if n.feature < 0:
        return end(at)
    return F.when(F.col("_bins")[n.feature] <= n.bin, _walk(tree, end, n.left)).otherwise(_walk(tree, end, n.left + 1))


def best_splits(rows: DataFrame, node: Column, columns: Sequence[int], p: Mapping[str, float]) -> DataFrame:
    """One row per node: (node, g, h) of all its rows and, if a split is worth it, its feature, bin, gain and (left_g, left_h).

    ``rows`` holds ``_bins`` and the derivatives ``_g`` and ``_h``.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), F.col("_bins")[k].cast("int").alias("bin")) for k in columns]))
    sums = (
        rows.select(node.alias("node"), "_g", "_h", cells.alias("c")).where("node >= 0")
        .groupBy("node", "c.feature", "c.bin").agg(F.sum("_g").alias("g"), F.sum("_h").alias("h"))
    )
    ordered = Window.partitionBy("node", "feature").orderBy("bin")
    whole = Window.partitionBy("node", "feature")
    left = sums.select(
        "node", "feature", "bin", *[F.sum(c).over(ordered).alias(f"left_{c}") for c in "gh"], *[F.sum(c).over(whole).alias(c) for c in "gh"],
        F.max("bin").over(whole).alias("_last"),
    )
    g, h, lg, lh = (F.col(c) for c in ("g", "h", "left_g", "left_h"))
    worth = lambda a, b: _worth(a, b, p["reg_alpha"], p["reg_lambda"])
    gain = F.round(worth(lg, lh) + worth(g - lg, h - lh) - worth(g, h), 9)  # the order of a sum shall not decide between equal gains
    least = F.lit(float(p["min_child_weight"]))
    valid = (F.col("bin") < F.col("_last")) & (lh >= least) & (h - lh >= least) & (gain > max(p["gamma"], 1e-9))
    found = F.when(valid, F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), lg.alias("left_g"), lh.alias("left_h")))
    best = left.groupBy("node").agg(F.max(found).alias("s"), F.min_by("g", "feature").alias("g"), F.min_by("h", "feature").alias("h"))
    return best.select("node", "g", "h", "s.gain", (-F.col("s.f")).alias("feature"), (-F.col("s.b")).alias("bin"), "s.left_g", "s.left_h")


def _grow(rows: DataFrame, columns: Sequence[int], edges: Sequence[Sequence[float]], p: Mapping[str, float]) -> tuple[Node, ...]:
    """One tree, level by level."""
    tree: list[Node] = [Node(0.0, 0.0)]
    open_ = [0]
    for _ in range(int(p["max_depth"])):
        looked = set(open_)
        node = _walk(tree, lambda at: F.lit(at if at in looked else -1))
        found = best_splits(rows, node, columns, p).collect()
        open_ = []
        for r in sorted(found, key=lambda r: r["node"]):
            at, value = r["node"], _leaf(r["g"], r["h"], p)
            if r["gain"] is None:
                tree[at] = Node(value, r["h"])
                continue
            k, b, left = r["feature"], r["bin"], len(tree)
            # past the last edge lie the missing values alone
            threshold = edges[k][b] if b < len(edges[k]) else math.inf
            tree[at] = Node(value, r["h"], k, b, threshold, left, r["gain"])
            for g, h in ((r["left_g"], r["left_h"]), (r["g"] - r["left_g"], r["h"] - r["left_h"])):
                open_.append(len(tree))
                tree.append(Node(_leaf(g, h, p), h))
        if not open_:
            break
    return tuple(tree)


def _edges(rows: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """Upper ends of all bins but the last, per feature (one at least). Their number is bounded, whatever the number of rows."""
    shares = [k / max_bins for k in range(1, max_bins)]
    cuts = rows.select(*[F.col(f).cast("double").alias(f) for f in features]).approxQuantile(list(features), [0.0, *shares, 1.0], 0.25 / max_bins)
    return [sorted({x for x in c if not math.isnan(x)})[:-1] or [sys.float_info.max / 2] for c in cuts]


def _binned(df: DataFrame, features: Sequence[str], edges: Sequence[Sequence[float]], *others: Column) -> DataFrame:
    names = [f"_b{k}" for k in range(len(features))]
    # buckets are closed on the left, bins on the right: the next larger double makes one of the other
    splits = [[-math.inf, *[math.nextafter(x, math.inf) for x in e], math.inf] for e in edges]
    plain = df.select(*[F.coalesce(F.col(f).cast("double"), F.lit(math.nan)).alias(f"_x{k}") for k, f in enumerate(features)], *others)
    cut = Bucketizer(splitsArray=splits, inputCols=[f"_x{k}" for k in range(len(features))], outputCols=names, handleInvalid="keep").transform(plain)
    return cut.select(F.array(*[F.col(n).cast("short") for n in names]).alias("_bins"), *[c for c in cut.columns if not c.startswith(("_x", "_b"))])


def _patient(auc: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the best one so far, and whether ``patience`` rounds have passed since without a gain."""
    best = 0
    for k, x in enumerate(auc):
        if x > auc[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def train_boosted(
    df: DataFrame, features: Sequence[str], label: str = "DELAYED", preset: str | None = None, val_flag: str | None = None, max_bins: int = MAX_BINS,
    **overrides: object,
) -> BoostedTrees:
    """Trees trained on ``df``, with the parameters and presets of ``train_gbt`` and all regularisation terms.

    Rows whose boolean ``val_flag`` is true are not trained on; their AUC is measured after each round. With ``early_stopping_rounds`` training ends when
    that many rounds have brought no gain, and the model is cut to the best round. Rows without a label are left out. Without training rows
    of both classes there is nothing to learn, and the model has no trees.
    """
    params: dict = {"seed": 0, "gamma": 0.0, "reg_alpha": 0.0, "reg_lambda": 1.0, **resolve_params(preset, overrides, regularised=True)}
    features = list(features)
    assert_numeric(df.select(*features))
    known = df.where(F.col(label).isNotNull())
    held = F.coalesce(F.col(val_flag), F.lit(False)) if val_flag else F.lit(False)
    fitting = known.where(~held)
    classes = fitting.agg(F.count_distinct(F.col(label) == 1)).first()[0]
    if classes < 2:
        return BoostedTrees(tuple(features), ())
    edges = _edges(fitting, features, max_bins)
    heavy = class_weight(fitting, params, label)
    real = F.col(label) == 1
    rows = pin(_binned(known, features, edges, real.cast("double").alias("y"), held.alias("held"), F.monotonically_increasing_id().alias("row")))
    state = rows.withColumn("margins", F.array(F.lit(0.0)))  # where a block starts, then one for each of its rounds
    weight = F.when(F.col("y") == 1, F.lit(heavy)).otherwise(F.lit(1.0))
    trees: list[tuple[Node, ...]] = []
    auc: list[float] = []
    patience, rounds = params.get("early_stopping_rounds"), int(params["num_round"])
    drawn = max(1, round(float(params["colsample_bytree"]) * len(features)))
    share = float(params["subsample"])
    while len(trees) < rounds:
        for _ in range(min(BLOCK, rounds - len(trees))):
            at = len(trees)
            columns = sorted(random.Random(f"{params['seed']}-{at}").sample(range(len(features)), drawn))
            chance = 1 / (1 + F.exp(-F.element_at("margins", -1)))
            fit = state.where("NOT held")
            if share < 1:
                draw = F.pmod(F.xxhash64("row", F.lit(f"{params['seed']}-{at}")), F.lit(1_000_000)) / 1_000_000
                fit = fit.where(draw < share)
            derived = fit.withColumn("_p", chance).select("_bins", (weight * (F.col("_p") - F.col("y"))).alias("_g"), (weight * F.col("_p") * (1 - F.col("_p"))).alias("_h"))
            tree = _grow(derived, columns, edges, params)
            trees.append(tree)
            more = F.element_at("margins", -1) + _walk(tree, lambda k, t=tree: F.lit(t[k].value))
            state = state.withColumn("margins", F.concat("margins", F.array(more)))
        state = pin(state)
        if val_flag:
            auc += _aucs(state.where("held"))
            if patience and auc:
                best, done = _patient(auc, int(patience))
                if done:
                    return BoostedTrees(tuple(features), tuple(trees[:best]), tuple(auc))
        state = state.withColumn("margins", F.array(F.element_at("margins", -1)))
    model = BoostedTrees(tuple(features), tuple(trees), tuple(auc))
    return model.first(_patient(auc, int(patience))[0]) if patience and auc else model


def _aucs(held: DataFrame) -> list[float]:
    """Exact AUC of each round of a block, all rounds in one evaluation; empty without validation rows of both classes."""
    long = held.select("y", F.posexplode("margins").alias("round", "margin")).where("round > 0")
    found = evaluate(long, 0.0, ["round"], "margin", "y").select("round", "auc").collect()
    return [r["auc"] for r in sorted(found, key=lambda r: r["round"])] if found and all(r["auc"] is not None for r in found) else []


def _leaf_of(tree: Sequence[Node], values: Sequence[Column], at: int = 0) -> Column:
    """The weight that a tree gives to raw feature values, as one conditional. NULL and NaN are not below any threshold."""
    n = tree[at]
    if n.feature < 0:
        return F.lit(n.value)
    return F.when(values[n.feature] <= n.threshold, _leaf_of(tree, values, n.left)).otherwise(_leaf_of(tree, values, n.left + 1))


def _flat(values: Sequence[float], kind: str) -> Column:
    """An array that the optimizer folds into one literal, whatever its length."""
    words = {math.inf: "Infinity", -math.inf: "-Infinity"}
    shown = ["NaN" if v != v else words.get(v, repr(v)) for v in values]
    return F.split(F.lit(",".join(shown)), ",").cast(f"array<{kind}>")


def _walked(model: BoostedTrees, values: Sequence[Column]) -> Column:
    """The margin from flat arrays of all nodes: each tree is walked from its root, as many steps as the deepest tree has levels."""
    nodes, roots, deepest = [], [], 0
    for tree in model.trees:
        base = len(nodes)
        roots.append(base)
        level = [0] * len(tree)
        for k, n in enumerate(tree):
            nodes.append((n.feature, n.threshold, base + n.left, n.value))
            if n.feature >= 0:
                level[n.left] = level[n.left + 1] = level[k] + 1
        deepest = max(deepest, *level)
    feature, threshold, left, value = (_flat([n[k] for n in nodes], kind) for k, kind in enumerate(("int", "double", "int", "double")))
    steps = _flat(range(max(1, deepest)), "int")  # a step at a leaf goes nowhere

    def margin(x: Column) -> Column:
        down = lambda at, _: F.when(feature[at] < 0, at).otherwise(left[at] + F.when(F.get(x, feature[at]) <= threshold[at], 0).otherwise(1))
        return F.aggregate(_flat(roots, "int"), F.lit(0.0), lambda sum_, root: sum_ + value[F.aggregate(steps, root, down)])

    return F.transform(F.array(F.array(*values)), margin)[0]


def score_boosted(model: BoostedTrees, df: DataFrame, threshold: float = 0.5, expression_nodes: int = EXPRESSION_NODES) -> DataFrame:
    """Every input row with its probability of class 1 and the class at ``threshold``; runs on streams, too.

    Up to ``expression_nodes`` nodes the trees are conditionals, which are compiled; more would be too much code for a stage, and the trees are walked in
    flat arrays instead. Both ways give the same values.
    """
    values = [F.col(f).cast("double") for f in model.features]
    if sum(map(len, model.trees)) <= expression_nodes:
        margin = F.lit(0.0)
        for tree in model.trees:
            margin = margin + _leaf_of(tree, values)
    else:
        margin = _walked(model, values)
    return df.withColumn("probability", 1 / (1 + F.exp(-margin))).withColumn("prediction", classify("probability", threshold))


def gain_importances(model: BoostedTrees, spark: SparkSession, top: int | None = None) -> DataFrame:
    """Features by their share of all gain, highest first; one row per feature."""
    ranked = spark.createDataFrame(list(model.gains().items()), "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return ranked if top is None else ranked.limit(top)
