"""Metrics and curves against direct computation, including ties, single-class data and skewed scores."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from conftest import rows
from latewatch.operators import metrics as mt


def brute(data, t):
    tp = sum(1 for p, y in data if p >= t and y == 1)
    fp = sum(1 for p, y in data if p >= t and y == 0)
    fn = sum(1 for p, y in data if p < t and y == 1)
    return tp, fp, fn, len(data) - tp - fp - fn


def brute_auc(data):
    pos = [p for p, y in data if y == 1]
    neg = [p for p, y in data if y == 0]
    if not pos or not neg:
        return None
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def groups():
    rnd = random.Random(3)
    out = {"ties": [(rnd.choice([0.1, 0.5, 0.5, 0.9]), rnd.randint(0, 1)) for _ in range(300)]}
    out["tiny"] = [(rnd.expovariate(1e6), rnd.randint(0, 1)) for _ in range(300)]  # all in one fixed-width cell
    out["hot"] = [(0.42 if i % 3 else rnd.random(), rnd.randint(0, 1)) for i in range(400)]
    out["ones"] = [(rnd.random(), 1) for _ in range(20)]
    out["zeros"] = [(rnd.random(), 0) for _ in range(20)]
    out[None] = [(rnd.random(), rnd.randint(0, 1)) for _ in range(100)]
    return out


@pytest.fixture(scope="module")
def df(spark, groups):
    data = [(g, p, y) for g, rs in groups.items() for p, y in rs]
    data += [("ties", None, 1), ("ties", 0.3, None)]
    return spark.createDataFrame(data, "g string, probability double, label int").repartition(6)


def test_evaluate_every_group(df, groups):
    got = {r.g: r for r in mt.evaluate(df, 0.5, ["g"]).collect()}
    assert set(got) == set(groups)
    for g, data in groups.items():
        r, (tp, fp, fn, tn) = got[g], brute(data, 0.5)
        assert (r.true_positive, r.false_positive, r.false_negative, r.true_negative) == (tp, fp, fn, tn)
        assert r.accuracy == pytest.approx((tp + tn) / len(data))
        assert r.precision == pytest.approx(tp / (tp + fp) if tp + fp else 0)
        assert r.recall == pytest.approx(tp / (tp + fn) if tp + fn else 0)
        assert r.f1_score == pytest.approx(2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0)
        auc = brute_auc(data)
        assert r.auc is None if auc is None else r.auc == pytest.approx(auc, abs=1e-12)


def test_confusion_adds_up_and_matches_evaluate(df):
    c = mt.binary_metrics(df, 0.5, ["g"]).drop("auc")
    assert rows(c) == rows(mt.evaluate(df, 0.5, ["g"]).select(*c.columns))


def test_auc_is_antisymmetric_and_agrees_with_spark_ml(df):
    one = df.where("g = 'hot'")
    a = mt.roc_auc(one).first().auc
    b = mt.roc_auc(one.withColumn("probability", 1 - F.col("probability"))).first().auc
    assert a == pytest.approx(1 - b)
    ml = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="y", numBins=0)
    assert a == pytest.approx(ml.evaluate(one.withColumn("y", F.col("label").cast("double"))), abs=1e-9)


def test_auc_does_not_depend_on_cuts(df):
    one = df.where("g = 'tiny'")
    assert len({round(mt.roc_auc(one, edges=e).first().auc, 12) for e in ([], [1e-7, 1e-6], None)}) == 1


def test_empty_input(spark):
    none = spark.createDataFrame([], "probability double, label int")
    r = mt.evaluate(none).first()
    assert (r.true_positive, r.true_negative, r.f1_score, r.auc) == (0, 0, 0.0, None)
    assert mt.roc_curve(none).count() == 0


def _roc(data, drop):
    """Points from the definition: every distinct score as threshold; middle points on equal steps dropped."""
    P, N = sum(y for _, y in data), sum(1 - y for _, y in data)
    steps = []
    for t in sorted({p for p, _ in data}, reverse=True):
        steps.append((t, sum(1 for p, y in data if p == t and y == 0), sum(1 for p, y in data if p == t and y == 1)))
    out, fp, tp = [(float("inf"), 0.0, 0.0)], 0, 0
    for i, (t, n, p) in enumerate(steps):
        fp, tp = fp + n, tp + p
        keep = not drop or i in (0, len(steps) - 1) or (n, p) != steps[i + 1][1:]
        if keep:
            out.append((t, fp / N, tp / P))
    return sorted(out)


@pytest.mark.parametrize("g", ["ties", "tiny", "hot"])
@pytest.mark.parametrize("drop", [True, False])
def test_roc_curve(df, groups, g, drop):
    got = sorted(tuple(r) for r in mt.roc_curve(df.where(F.col("g") == g), drop_intermediate=drop).collect())
    assert got == [tuple(pytest.approx(x) for x in r) for r in _roc(groups[g], drop)]


def test_roc_curve_by_group_equals_single(df):
    both = mt.roc_curve(df, ["g"]).where("g = 'hot'").drop("g")
    assert rows(both) == rows(mt.roc_curve(df.where("g = 'hot'")))


@pytest.mark.parametrize("g", ["ties", "hot"])
def test_pr_curve_and_best_threshold(df, groups, g):
    data, one = groups[g], df.where(F.col("g") == g)
    P = sum(y for _, y in data)
    want, best = [(None, 1.0, 0.0)], None
    for t in sorted({p for p, _ in data}):
        tp, fp, _, _ = brute(data, t)
        pr, rc = tp / (tp + fp), tp / P
        want.append((t, pr, rc))
        f1 = 2 * (pr * rc) / (pr + rc + 1e-8)
        if best is None or f1 > best[3]:
            best = (t, pr, rc, f1)
    got = {r.threshold: (r.precision, r.recall) for r in mt.pr_curve(one).collect()}
    assert got == {t: (pytest.approx(a), pytest.approx(b)) for t, a, b in want}
    assert tuple(mt.best_threshold(one).first()) == pytest.approx(best)


def test_best_threshold_takes_the_lowest_of_equals(spark):
    # thresholds 0.2 and 0.9 both give F1 of about 2/3
    df = spark.createDataFrame([(0.9, 1), (0.2, 0), (0.2, 0), (0.2, 1), (0.1, 0)], "probability double, label int")
    f1 = {r.threshold: 2 * r.precision * r.recall / (r.precision + r.recall + 1e-8) for r in mt.pr_curve(df).where("threshold IS NOT NULL").collect()}
    top = max(f1.values())
    assert mt.best_threshold(df).first().threshold == min(t for t, v in f1.items() if v == top)


def test_pr_curve_without_positives(df):
    assert {r.recall for r in mt.pr_curve(df.where("g = 'zeros'")).where("threshold IS NOT NULL").collect()} == {1.0}


def test_threshold_sweep(df, groups):
    got = mt.threshold_sweep(df.where("g = 'hot'")).orderBy("threshold").collect()
    f1s = []
    for r in got:
        tp, fp, fn, _ = brute(groups["hot"], r.threshold)
        assert (r.precision, r.recall) == (pytest.approx(tp / (tp + fp) if tp + fp else 0), pytest.approx(tp / (tp + fn)))
        f1s.append(r.f1)
    assert [r.is_best for r in got] == [i == f1s.index(max(f1s)) for i in range(5)]


def test_report_paths(df):
    rep = mt.evaluation_report(mt.evaluate(df.where("g = 'hot'")))
    r = rep.select(mt.metric("f1_score").alias("a"), F.to_json(F.struct("metrics")).alias("j")).select(
        "a", mt.metric("f1_score", "j").alias("b")).first()
    assert r.a == r.b


def test_best_per_metric_prefers_the_first_version(spark):
    m = spark.createDataFrame([(1, 0.6, 0.5, 0.5, 0.4), (2, 0.6, 0.7, 0.1, 0.4)],
                              "version int, auc double, precision double, recall double, f1_score double")
    assert {r.metric: r.version for r in mt.best_per_metric(m).collect()} == {
        "auc": 1, "precision": 2, "recall": 1, "f1_score": 1}
