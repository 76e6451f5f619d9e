"""Registered queries over scored rows: metrics, curves, comparison, gate, monitoring, training."""

from __future__ import annotations

import math
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch.operators import boosting as bo
from latewatch.operators import gate as gt
from latewatch.operators import metrics as mt
from latewatch.operators import model as ml
from latewatch.operators import monitor as mo
from latewatch.operators import profile as pf
from latewatch.operators.matrix import add_distance_features, add_temporal_features
from latewatch.plans.registry import query, rounded
from latewatch.plans.tables import FEATURED, LABELLED, SCORED, TRUTH, labelled, scored, table, truth
from latewatch.runtime import pin, scratch_path
from latewatch.schemas import FEATURE_SETS

# ---------------------------------------------------------------- SQL building blocks


def _confusion_sql(source: str, by: str = "", threshold: float = 0.5) -> str:
    keys = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return f"""
SELECT {keys}
  COUNT(*) FILTER (probability < {threshold} AND label = 0) AS true_negative,
  COUNT(*) FILTER (probability >= {threshold} AND label = 0) AS false_positive,
  COUNT(*) FILTER (probability < {threshold} AND label = 1) AS false_negative,
  COUNT(*) FILTER (probability >= {threshold} AND label = 1) AS true_positive
FROM {source}{group}"""


_ACC = "round((true_negative + true_positive) / CAST(true_negative + false_positive + false_negative + true_positive AS DOUBLE), 6)"
_PREC = "round(coalesce(true_positive / nullif(CAST(true_positive + false_positive AS DOUBLE), 0), 0), 6)"
_REC = "round(coalesce(true_positive / nullif(CAST(true_positive + false_negative AS DOUBLE), 0), 0), 6)"
_F1 = "round(coalesce(2 * true_positive / nullif(CAST(2 * true_positive + false_positive + false_negative AS DOUBLE), 0), 0), 6)"
_FOUR = "true_negative, false_positive, false_negative, true_positive"


def _evaluate_ctes(source: str, by: str = "", threshold: float = 0.5, name: str = "evaluated") -> str:
    """CTE ``name``: the four counts, accuracy, precision, recall, F1 and AUC of ``source`` per ``by``."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    group = f" GROUP BY {by}" if by else ""
    names = [k.strip() for k in by.split(",")] if by else []
    on = " AND ".join(f"c.{k} IS NOT DISTINCT FROM a.{k}" for k in names) or "TRUE"
    cols = "".join(f"c.{k}, " for k in names)
    return f"""
{name}_s AS (
  SELECT {keys}probability, COUNT(*) FILTER (label = 1) AS pos, COUNT(*) FILTER (label = 0) AS neg
  FROM {source} GROUP BY {keys}probability),
{name}_b AS (
  SELECT *, coalesce(SUM(neg) OVER ({part}ORDER BY probability
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM {name}_s),
{name}_a AS (
  SELECT {keys}SUM(pos * (below + neg / CAST(2 AS DOUBLE)))
           / nullif(CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE), 0) AS auc
  FROM {name}_b{group}),
{name}_c AS ({_confusion_sql(source, by, threshold)}),
{name} AS (
  SELECT {cols}{_FOUR}, {_ACC} AS accuracy, {_PREC} AS precision, {_REC} AS recall, {_F1} AS f1_score,
         round(auc, 6) AS auc
  FROM {name}_c AS c JOIN {name}_a AS a ON {on})"""


def _curve_ctes(by: str = "") -> str:
    """CTE ``curve``: per distinct score, counts at or above it and group totals."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""
sc AS (
  SELECT {keys}probability, COUNT(*) FILTER (label = 1) AS pos, COUNT(*) FILTER (label = 0) AS neg
  FROM scored GROUP BY {keys}probability),
curve AS (
  SELECT *, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp,
         CAST(SUM(pos) OVER ({part}) AS DOUBLE) AS p, CAST(SUM(neg) OVER ({part}) AS DOUBLE) AS n,
         lead(pos) OVER w2 AS pos_next, lead(neg) OVER w2 AS neg_next, row_number() OVER w2 AS k
  FROM sc
  WINDOW w AS ({part}ORDER BY probability DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         w2 AS ({part}ORDER BY probability DESC))"""


# ---------------------------------------------------------------- metrics


@query("confusion", f"WITH {SCORED} {_confusion_sql('scored')}")
def confusion(spark, sf):
    return mt.confusion(scored(spark, sf))


@query("binary_metrics", f"""
WITH {SCORED}, c AS ({_confusion_sql('scored', 'segment')})
SELECT segment, {_FOUR}, {_ACC} AS accuracy, {_PREC} AS precision, {_REC} AS recall, {_F1} AS f1_score FROM c""")
def binary_metrics(spark, sf):
    return rounded(mt.binary_metrics(scored(spark, sf), by=["segment"]))


_SPLIT_SCORED = f"""{SCORED}, split_scored AS (
  SELECT *, CASE WHEN day(ts) <= 12 THEN 'train' WHEN day(ts) <= 15 THEN 'val'
                 WHEN day(ts) <= 18 THEN 'test' ELSE 'prod' END AS split FROM scored)"""


@query("evaluate_by_split", f"WITH {_SPLIT_SCORED}, {_evaluate_ctes('split_scored', 'split')} SELECT * FROM evaluated")
def evaluate_by_split(spark, sf):
    day = F.day("ts")
    split = F.when(day <= 12, "train").when(day <= 15, "val").when(day <= 18, "test").otherwise("prod")
    return rounded(mt.evaluate_by(scored(spark, sf).withColumn("split", split), "split"))


@query("roc_auc", f"WITH {SCORED}, {_evaluate_ctes('scored', 'segment, version')} SELECT segment, version, auc FROM evaluated")
def roc_auc(spark, sf):
    return rounded(mt.roc_auc(scored(spark, sf), ["segment", "version"]))


@query("roc_curve", f"""
WITH {SCORED}, {_curve_ctes()}
SELECT probability AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM curve
WHERE k = 1 OR pos_next IS NULL OR pos <> pos_next OR neg <> neg_next
UNION ALL SELECT NULL, 0.0, 0.0""")
def roc_curve(spark, sf):
    return _finite(mt.roc_curve(scored(spark, sf)))


@query("roc_curve_all", f"""
WITH {SCORED}, {_curve_ctes('version')}
SELECT version, probability AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM curve
UNION ALL SELECT DISTINCT version, NULL, 0.0, 0.0 FROM scored""")
def roc_curve_all(spark, sf):
    return _finite(mt.roc_curve(scored(spark, sf), ["version"], drop_intermediate=False))


def _finite(curve: DataFrame) -> DataFrame:
    """The infinite starting threshold as NULL, which every engine prints alike."""
    return rounded(curve.withColumn("threshold", F.nullif("threshold", F.lit(float("inf")))))


@query("pr_curve", f"""
WITH {SCORED}, {_curve_ctes('version')}
SELECT version, probability AS threshold, round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision, round(tp / p, 6) AS recall
FROM curve UNION ALL SELECT DISTINCT version, NULL, 1.0, 0.0 FROM scored""")
def pr_curve(spark, sf):
    return rounded(mt.pr_curve(scored(spark, sf), ["version"]))


@query("best_threshold", f"""
WITH {SCORED}, {_curve_ctes('segment')}, f AS (
  SELECT segment, probability AS threshold, tp / CAST(tp + fp AS DOUBLE) AS pr, tp / p AS rc FROM curve),
g AS (SELECT *, 2 * (pr * rc) / (pr + rc + CAST(1e-8 AS DOUBLE)) AS f1 FROM f)
SELECT segment, threshold, round(pr, 6) AS precision, round(rc, 6) AS recall, round(f1, 6) AS f1 FROM g
QUALIFY row_number() OVER (PARTITION BY segment ORDER BY f1 DESC, threshold) = 1""")
def best_threshold(spark, sf):
    return rounded(mt.best_threshold(scored(spark, sf), ["segment"]))


@query("threshold_sweep", f"""
WITH {SCORED}, g AS (SELECT CAST(unnest([0.3, 0.4, 0.5, 0.6, 0.7]) AS DOUBLE) AS threshold),
c AS (
  SELECT threshold, COUNT(*) FILTER (probability >= threshold AND label = 1) AS tp,
    COUNT(*) FILTER (probability >= threshold AND label = 0) AS fp, COUNT(*) FILTER (label = 1) AS p
  FROM scored CROSS JOIN g GROUP BY threshold),
m AS (
  SELECT threshold, coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0) AS pr,
    coalesce(tp / nullif(CAST(p AS DOUBLE), 0), 0) AS rc,
    coalesce(2 * tp / nullif(CAST(tp + fp + p AS DOUBLE), 0), 0) AS f1 FROM c)
SELECT threshold, round(pr, 6) AS precision, round(rc, 6) AS recall, round(f1, 6) AS f1,
  threshold = (SELECT threshold FROM m ORDER BY f1 DESC, threshold LIMIT 1) AS is_best
FROM m""")
def threshold_sweep(spark, sf):
    return rounded(mt.threshold_sweep(scored(spark, sf)))


@query("score_stats", f"""
WITH {SCORED} SELECT version, COUNT(probability) AS n, round(AVG(probability), 6) AS mean_score,
  MIN(probability) AS min_score, MAX(probability) AS max_score FROM scored GROUP BY version""")
def score_stats(spark, sf):
    return rounded(pf.score_stats(scored(spark, sf), by=["version"]))


@query("prediction_summary", f"""
WITH {SCORED}, c AS (
  SELECT COUNT(*) AS total, COUNT(*) FILTER (probability < 0.5) AS on_time,
         COUNT(*) FILTER (probability >= 0.5) AS delayed FROM scored)
SELECT total, on_time, delayed, round(on_time * 100 / CAST(total AS DOUBLE), 6) AS on_time_pct,
  round(delayed * 100 / CAST(total AS DOUBLE), 6) AS delayed_pct FROM c""")
def prediction_summary(spark, sf):
    return rounded(pf.prediction_summary(scored(spark, sf)))


@query("evaluation_report", f"""
WITH {SCORED}, {_evaluate_ctes('scored', 'segment')}
SELECT segment, f1_score, auc, precision, true_positive, true_negative FROM evaluated""")
def evaluation_report(spark, sf):
    """Build the nested report, then read metrics back by path, as a gate does."""
    report = mt.evaluation_report(mt.evaluate(scored(spark, sf), by=["segment"]), ["segment"])
    as_text = report.withColumn("json", F.to_json(F.struct("metrics", "confusion_matrix")))
    return rounded(as_text.select(
        "segment", mt.metric("f1_score").alias("f1_score"), mt.metric("auc", "json").alias("auc"),
        mt.metric("precision").alias("precision"),
        F.col("confusion_matrix.true_positive").alias("true_positive"),
        F.col("confusion_matrix.true_negative").alias("true_negative"),
    ))


# ---------------------------------------------------------------- comparison and gate


@query("compare_models", f"WITH {SCORED}, {_evaluate_ctes('scored', 'version')} SELECT * FROM evaluated")
def compare_models(spark, sf):
    return rounded(mt.compare_models(scored(spark, sf)))


@query("best_model_per_metric", f"""
WITH {SCORED}, {_evaluate_ctes('scored', 'version')}, long AS (
  SELECT 'auc' AS metric, version, auc AS value FROM evaluated
  UNION ALL SELECT 'precision', version, precision FROM evaluated
  UNION ALL SELECT 'recall', version, recall FROM evaluated
  UNION ALL SELECT 'f1_score', version, f1_score FROM evaluated)
SELECT metric, version, value FROM long
QUALIFY row_number() OVER (PARTITION BY metric ORDER BY value DESC, version) = 1""")
def best_model_per_metric(spark, sf):
    return mt.best_per_metric(rounded(mt.compare_models(scored(spark, sf))))


_RUNS_BY = "version, run_day"
_RUNS = f"""{SCORED}, runs AS (SELECT *, CAST(ts AS DATE) AS d,
  CAST(day(ts) AS INTEGER) AS run_day FROM scored), {_evaluate_ctes('runs', _RUNS_BY, 0.92)}"""


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    """A table of model runs: each version evaluated for each day, at a strict threshold so that some fail."""
    return mt.evaluate(scored(spark, sf).withColumn("run_day", F.day("ts")), 0.92, ["version", "run_day"])


def _diagnosis_sql(of: dict[str, str]) -> str:
    return (f"CASE WHEN f1_score < 0.10 THEN '{of['poor']}' WHEN precision < 0.15 THEN '{of['precision']}' "
            f"WHEN recall < 0.20 THEN '{of['recall']}' ELSE '{of['close']}' END")


@query("quality_gate", f"""
WITH {_RUNS} SELECT version, run_day, f1_score, precision, recall, f1_score >= 0.20 AS passed,
  {_diagnosis_sql(gt.DIAGNOSES)} AS diagnosis, {_diagnosis_sql(gt.NEXT_STEPS)} AS next_step FROM evaluated""")
def quality_gate(spark, sf):
    gated = gt.diagnose(gt.quality_gate(rounded(_runs(spark, sf)), 0.20))
    return gated.select("version", "run_day", "f1_score", "precision", "recall", "passed", "diagnosis", "next_step")


def _texts(items) -> str:
    return "'" + "; ".join(items) + "'"


@query("rejections", f"""
WITH {_RUNS} SELECT version, run_day, '{gt.REJECTED}' AS status, '{gt.REJECTION_REASON}' AS rejection_reason,
  CAST(0.20 AS DOUBLE) AS required, f1_score AS actual, round(0.20 - f1_score, 6) AS gap, auc,
  concat_ws('; ', CASE WHEN f1_score < 0.10 THEN {_texts(gt.ADVICE_POOR)} END,
    CASE WHEN precision < 0.15 OR recall < 0.20 THEN {_texts(gt.ADVICE_FEATURES)} END,
    {_texts(gt.ADVICE_ALWAYS)}) AS recommendations
FROM evaluated WHERE f1_score < 0.20""")
def rejections(spark, sf):
    report = gt.rejection_report(rounded(_runs(spark, sf)), 0.20, ["version", "run_day"])
    return rounded(report.select(
        "version", "run_day", "status", "rejection_reason", "threshold.required", "threshold.actual", "threshold.gap",
        "model_metrics.auc", F.array_join("recommendations", "; ").alias("recommendations"),
    ))


@query("latest_version", """
SELECT event_type, event_id, user_id, value FROM events WHERE value > 50
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest_version(spark, sf):
    """The latest row that qualifies, per group: each event type's last event above 50."""
    events = table(spark, sf, "events").select("event_type", "event_id", "user_id", "value", "ts")
    return gt.latest_by(events, ["event_type"], ["ts", "event_id"], F.col("value") > 50).drop("ts")


# ---------------------------------------------------------------- monitoring

_BASE = f"""{TRUTH}, base AS (SELECT * FROM scored ORDER BY seq LIMIT 500),
{_evaluate_ctes('base', '', name='baseline')},
constraints AS (
  SELECT 'f1_score' AS metric, f1_score AS threshold FROM baseline
  UNION ALL SELECT 'precision', precision FROM baseline UNION ALL SELECT 'recall', recall FROM baseline
  UNION ALL SELECT 'accuracy', accuracy FROM baseline UNION ALL SELECT 'auc', auc FROM baseline)"""

_JOINED = f"""{_BASE}, joined AS (
  SELECT s.id, s.ts, date_trunc('day', s.ts) AS window_start, s.segment, s.probability, t.label, t.truth_ts
  FROM scored AS s JOIN truth AS t ON s.id = t.id AND t.truth_ts >= s.ts AND t.truth_ts <= s.ts + INTERVAL 1 DAY)"""


def _constraints(spark: SparkSession, sf: str) -> DataFrame:
    return mo.suggest_constraints(rounded(mo.baseline(scored(spark, sf), order_by="seq")))


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    return mo.join_ground_truth(scored(spark, sf).drop("label"), truth(spark, sf), "1 day")


def _windows(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(mo.evaluate_windows(_joined(spark, sf), "1 day"))


def _printed(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as text, free of session zones and precisions."""
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in names})


@query("baseline_constraints", f"""
WITH {_BASE} SELECT metric, threshold, 'LessThanThreshold' AS comparison_operator FROM constraints""")
def baseline_constraints(spark, sf):
    return _constraints(spark, sf)


@query("baseline_constraints_by_version", f"""
WITH {TRUTH}, base AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY version ORDER BY seq) <= 300),
{_evaluate_ctes('base', 'version', name='baseline')}, long AS (
  SELECT version, 'f1_score' AS metric, f1_score AS threshold FROM baseline UNION ALL SELECT version, 'precision', precision FROM baseline
  UNION ALL SELECT version, 'recall', recall FROM baseline UNION ALL SELECT version, 'accuracy', accuracy FROM baseline
  UNION ALL SELECT version, 'auc', auc FROM baseline)
SELECT version, metric, threshold, 'LessThanThreshold' AS comparison_operator FROM long""")
def baseline_constraints_by_version(spark, sf):
    """Constraints of each version from its own first rows."""
    base = mo.baseline(scored(spark, sf), 300, order_by="seq", by=["version"])
    return mo.suggest_constraints(rounded(base), by=["version"])


# the chance of at most k draws, for k from 0
_POISSON = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(12)]
_UNIFORM = "('0x' || substr(md5('11|' || replicate || '|' || id), 1, 8))::UBIGINT / 4294967296.0"


@query("baseline_constraints_bounded", f"""
WITH {TRUTH}, base AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY version ORDER BY seq) <= 300),
drawn AS (SELECT *, {_UNIFORM} AS u FROM (SELECT *, unnest(range(1, 61)) AS replicate FROM base)),
boot AS (SELECT version, replicate, probability, label, unnest(range({' + '.join(f'(u >= {x!r})::INT' for x in _POISSON)})) AS again FROM drawn),
{_evaluate_ctes('boot', 'version, replicate', name='resampled')}, long AS (
  {" UNION ALL ".join(f"SELECT version, '{m}' AS metric, quantile_cont({m}, 0.1) AS threshold FROM resampled GROUP BY version" for m in mo.BASELINE_METRICS)})
SELECT version, metric, round(threshold, 5) AS threshold, 'LessThanThreshold' AS comparison_operator FROM long""")
def baseline_constraints_bounded(spark, sf):
    """Constraints of each version that nine of ten resampled baselines meet, instead of the bare baseline value."""
    bounds = mo.bounded_constraints(scored(spark, sf), 300, "seq", level=0.9, replicates=60, by=["version"], seed=11)
    return rounded(bounds, 5)


@query("ground_truth_join_reused_ids", f"""
WITH {TRUTH}, s AS (SELECT seq % 50 AS id, ts, min(probability) AS probability FROM scored GROUP BY ALL),
t AS (SELECT DISTINCT CAST(CAST(id AS BIGINT) % 50 AS BIGINT) AS id, label, truth_ts FROM truth),
j AS (SELECT t.id, t.label, t.truth_ts, s.ts, s.probability FROM t JOIN s ON s.id = t.id AND t.truth_ts >= s.ts AND t.truth_ts <= s.ts + INTERVAL 2 DAY
  QUALIFY row_number() OVER (PARTITION BY t.id, t.label, t.truth_ts ORDER BY s.ts DESC, s.probability DESC) = 1)
SELECT id, label, probability, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, strftime(truth_ts, '%Y-%m-%d %H:%M:%S') AS truth_ts FROM j""")
def ground_truth_join_reused_ids(spark, sf):
    """Fifty ids used again and again: each truth row belongs to the latest scored row before it."""
    rows = scored(spark, sf).groupBy(F.pmod("seq", F.lit(50)).alias("id"), "ts").agg(F.min("probability").alias("probability"))
    labels = truth(spark, sf).select(F.pmod(F.col("id").cast("bigint"), F.lit(50)).alias("id"), "label", "truth_ts")
    return _printed(mo.join_ground_truth(rows, labels, "2 days").select("id", "label", "probability", "ts", "truth_ts"), "ts", "truth_ts")


@query("ground_truth_join", f"""
WITH {_JOINED} SELECT id, segment, probability, label, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
  strftime(truth_ts, '%Y-%m-%d %H:%M:%S') AS truth_ts FROM joined""")
def ground_truth_join(spark, sf):
    joined = _joined(spark, sf).select("id", "segment", "probability", "label", "ts", "truth_ts")
    return _printed(joined, "ts", "truth_ts")


@query("window_quality", f"""
WITH {_JOINED}, {_evaluate_ctes('joined', 'window_start')}
SELECT * REPLACE (strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start) FROM evaluated""")
def window_quality(spark, sf):
    return _printed(_windows(spark, sf), "window_start")


@query("violations", f"""
WITH {_JOINED}, {_evaluate_ctes('joined', 'window_start')}, long AS (
  SELECT window_start, 'f1_score' AS metric, f1_score AS value FROM evaluated
  UNION ALL SELECT window_start, 'precision', precision FROM evaluated
  UNION ALL SELECT window_start, 'recall', recall FROM evaluated
  UNION ALL SELECT window_start, 'accuracy', accuracy FROM evaluated
  UNION ALL SELECT window_start, 'auc', auc FROM evaluated)
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, metric, value, threshold,
  'LessThanThreshold' AS comparison_operator, true AS violated
FROM long JOIN constraints USING (metric) WHERE value < threshold""")
def violations(spark, sf):
    return _printed(mo.violations(_windows(spark, sf), _constraints(spark, sf), ["window_start"]), "window_start")


@query("f1_alarm", f"""
WITH {TRUTH}, hourly AS (
  SELECT time_bucket(INTERVAL 2 HOUR, ts) AS window_start, probability, label FROM scored),
{_evaluate_ctes('hourly', 'window_start', 0.6)},
avgs AS (SELECT time_bucket(INTERVAL 10 MINUTE, window_start) AS period_start, AVG(f1_score) AS average
         FROM evaluated GROUP BY 1),
spine AS (SELECT unnest(generate_series((SELECT min(period_start) FROM avgs), (SELECT max(period_start) FROM avgs),
                                        INTERVAL 10 MINUTE)) AS period_start)
SELECT strftime(spine.period_start, '%Y-%m-%d %H:%M:%S') AS period_start, average,
  coalesce(average <= 0.4, true) AS in_alarm
FROM spine LEFT JOIN avgs ON avgs.period_start = spine.period_start""")
def f1_alarm(spark, sf):
    """Metrics of two-hour windows, so that most 600 s periods have no data and alarm for that reason."""
    hourly = rounded(mo.evaluate_windows(scored(spark, sf), "2 hours", threshold=0.6))
    return _printed(mo.alarm(hourly, threshold=0.4), "period_start")


@query("stream_summary", f"""
WITH {SCORED} SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, COUNT(*) AS n,
  round(AVG(CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END) * 100, 6) AS predicted_rate,
  round(AVG(label) * 100, 6) AS delay_rate
FROM scored GROUP BY 1""")
def stream_summary(spark, sf):
    return _printed(rounded(mo.stream_summary(scored(spark, sf))), "window_start")


# ---------------------------------------------------------------- training: one stump has a SQL twin, whole boosting has none

_FLAGS = ("IS_PEAK_HOUR", "IS_WEEKEND", "IS_LONG_HAUL")


def _stump_sql(select: str) -> str:
    """A tree of depth 1 on flags: the flag with the largest gain in variance of the labels -1 and 1, and the mean of each side."""
    sides = " UNION ALL ".join(
        f"""SELECT {k} AS place, '{f}' AS feature, "{f}" AS flag, COUNT(*) AS n, AVG("DELAYED" * 2.0 - 1) AS mean FROM featured WHERE split = 'train' GROUP BY "{f}\""""
        for k, f in enumerate(_FLAGS)
    )
    return f"""
WITH {FEATURED}, sides AS ({sides}),
gains AS (SELECT place, feature, SUM(n * mean * mean) AS gain FROM sides GROUP BY ALL HAVING COUNT(*) = 2),
best AS (SELECT feature FROM gains ORDER BY gain DESC, place LIMIT 1) {select}"""


def _stump(spark: SparkSession, sf: str):
    df = add_distance_features(add_temporal_features(labelled(spark, sf))).select("split", "DELAYED", *_FLAGS)
    options = {"max_depth": 1, "num_round": 1, "eta": 1.0, "subsample": 1.0, "colsample_bytree": 1.0, "scale_pos_weight": 1.0, "seed": 7}
    return ml.train_gbt(df.where("split = 'train'"), list(_FLAGS), **options), df


@query("stump_scores", _stump_sql(f"""
SELECT f.split, {', '.join(f'f."{x}"' for x in _FLAGS)}, COUNT(*) AS n, round(any_value(1 / (1 + exp(-2 * s.mean))), 6) AS probability
FROM featured AS f, best JOIN sides AS s ON s.feature = best.feature
WHERE s.flag = CASE best.feature {' '.join(f"""WHEN '{x}' THEN f."{x}\"""" for x in _FLAGS)} END GROUP BY ALL"""))
def stump_scores(spark, sf):
    """Train one stump on the training split, score all rows."""
    model, df = _stump(spark, sf)
    by = ml.score(model, df).groupBy("split", *_FLAGS).agg(F.count("*").alias("n"), F.max("probability").alias("probability"))
    return rounded(by)


@query("stump_importances", _stump_sql("""
SELECT g.feature, CASE WHEN g.feature = best.feature THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS importance FROM gains AS g, best"""))
def stump_importances(spark, sf):
    model, df = _stump(spark, sf)
    return rounded(ml.importances(model, list(_FLAGS), df))


@query("model_round_trip", f"""WITH {FEATURED} SELECT COUNT(*) AS n, CAST(0 AS BIGINT) AS n_different FROM featured""")
def model_round_trip(spark, sf):
    """A saved model scores every row as the one it was saved from."""
    model, df = _stump(spark, sf)
    path = scratch_path(spark, "model")
    ml.save(model, path)
    both = ml.score(ml.load(path), ml.score(model, df).withColumnsRenamed({"probability": "p", "prediction": "c"}))
    return both.agg(F.count("*").alias("n"), F.count_if(F.col("p") != F.col("probability")).alias("n_different"))


@query("presets", f"""
WITH {LABELLED}, w AS (SELECT COUNT(*) FILTER ("DELAYED" = 0) / CAST(COUNT(*) FILTER ("DELAYED" = 1) AS DOUBLE) AS ratio FROM labelled WHERE split = 'train')
SELECT preset, round(CASE preset WHEN 'notebook' THEN ratio WHEN 'smoothed' THEN least(ratio, 3.0) ELSE fixed END, 6) AS pos_weight
FROM w, (VALUES ('baseline', 5.5), ('improved', 5.5), ('raw_benchmark', 4.58), ('engineered', 4.58), ('notebook', 0), ('smoothed', 0)) AS p(preset, fixed)""")
def presets(spark, sf):
    """The class weight that each preset trains with on the training split."""
    train = labelled(spark, sf).where("split = 'train'")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # what presets leave out is no news here
        weights = {p: ml.resolve_params(p) for p in ml.PARAMS}
    measured = pf.pos_weight(train).select("pos_weight")
    rows = [
        F.struct(F.lit(p).alias("preset"), (
            F.least(F.col("pos_weight"), F.lit(float(w.get("pos_weight_cap", float("inf"))))) if w["scale_pos_weight"] == "auto"
            else F.lit(float(w["scale_pos_weight"]))
        ).alias("pos_weight"))
        for p, w in weights.items()
    ]
    return rounded(measured.select(F.inline(F.array(*rows))))


# ---------------------------------------------------------------- regularised boosting: some rounds on flags have SQL twins

_BOOST = {
    "eta": 0.5, "reg_alpha": 0.5, "reg_lambda": 2.0, "gamma": 0.0, "min_child_weight": 1, "scale_pos_weight": 2.0, "subsample": 1.0, "colsample_bytree": 1.0, "seed": 7,
}


def _boosted_sql(rounds: int, depth: int) -> str:
    """CTEs of level-wise boosting on flags, over counts of equal rows: ``m0`` … ``m<rounds>`` hold (split, flags, y, n, margin, gone margins)."""
    flags = [f"f{k}" for k in range(len(_FLAGS))]
    shrunk = lambda g: f"(sign({g}) * greatest(abs({g}) - {_BOOST['reg_alpha']}, 0))"
    worth = lambda g, h: f"{shrunk(g)} * {shrunk(g)} / ({h} + {_BOOST['reg_lambda']})"
    parts = [f"""m0 AS (
  SELECT split, {', '.join(f'"{x}" AS {f}' for x, f in zip(_FLAGS, flags))}, CAST("DELAYED" AS DOUBLE) AS y, COUNT(*) AS n, CAST(0 AS DOUBLE) AS margin
  FROM featured GROUP BY ALL)"""]
    for r in range(1, rounds + 1):
        parts.append(f"""d{r}_0 AS (
  SELECT *, 1 AS node, w * (p - y) AS g, w * p * (1 - p) AS h FROM (
    SELECT *, n * CASE WHEN y = 1 THEN {_BOOST['scale_pos_weight']} ELSE 1.0 END AS w, 1 / (1 + exp(-margin)) AS p FROM m{r - 1}))""")
        for level in range(1, depth + 1):
            d = f"d{r}_{level - 1}"
            cells = " UNION ALL ".join(f"SELECT node, {k} AS k, {f} AS v, SUM(g) AS g, SUM(h) AS h FROM {d} WHERE split = 'train' GROUP BY node, {f}" for k, f in enumerate(flags))
            parts.append(f"""c{r}_{level} AS ({cells}),
b{r}_{level} AS (
  SELECT a.node, a.k, round({worth('a.g', 'a.h')} + {worth('b.g', 'b.h')} - {worth('(a.g + b.g)', '(a.h + b.h)')}, 9) AS gain
  FROM c{r}_{level} AS a JOIN c{r}_{level} AS b ON a.node = b.node AND a.k = b.k AND a.v = 0 AND b.v = 1
  WHERE a.h >= {_BOOST['min_child_weight']} AND b.h >= {_BOOST['min_child_weight']}
  QUALIFY gain > 1e-9 AND row_number() OVER (PARTITION BY a.node ORDER BY gain DESC, a.k) = 1),
d{r}_{level} AS (
  SELECT d.* EXCLUDE (node), CASE WHEN b.k IS NULL THEN d.node * 2 ELSE d.node * 2 + CASE b.k {' '.join(f'WHEN {k} THEN {f}' for k, f in enumerate(flags))} END END AS node
  FROM {d} AS d LEFT JOIN b{r}_{level} AS b ON b.node = d.node)""")
        parts.append(f"""l{r} AS (
  SELECT node, -{_BOOST['eta']} * {shrunk('SUM(g)')} / (SUM(h) + {_BOOST['reg_lambda']}) AS leaf FROM d{r}_{depth} WHERE split = 'train' GROUP BY node),
m{r} AS (SELECT d.* EXCLUDE (node, g, h, w, p, margin), margin + leaf AS margin FROM d{r}_{depth} AS d JOIN l{r} AS l ON l.node = d.node)""")
    return ",\n".join(parts)


def _flag_rows(spark: SparkSession, sf: str) -> DataFrame:
    return add_distance_features(add_temporal_features(labelled(spark, sf))).select("split", "DELAYED", *_FLAGS)


def _boosted(spark: SparkSession, sf: str, **options):
    df = _flag_rows(spark, sf)
    return bo.train_boosted(df.where("split = 'train'"), list(_FLAGS), **_BOOST, **options), df


def _boosted_scores(spark: SparkSession, sf: str, **options) -> DataFrame:
    model, df = _boosted(spark, sf, **options)
    return rounded(bo.score_boosted(model, df).groupBy("split", *_FLAGS).agg(F.count("*").alias("n"), F.max("probability").alias("probability")))


def _boosted_scores_sql(rounds: int, depth: int) -> str:
    named = ", ".join(f'f{k} AS "{x}"' for k, x in enumerate(_FLAGS))
    return f"""WITH {FEATURED}, {_boosted_sql(rounds, depth)}
SELECT split, {named}, SUM(n)::BIGINT AS n, round(max(1 / (1 + exp(-margin))), 6) AS probability FROM m{rounds} GROUP BY split, f0, f1, f2"""


@query("boosted_two_rounds", _boosted_scores_sql(2, 1))
def boosted_two_rounds(spark, sf):
    """Two regularised stumps on flags, one upon the other, as scores of all rows."""
    return _boosted_scores(spark, sf, num_round=2, max_depth=1)


@query("boosted_depth_two", _boosted_scores_sql(1, 2))
def boosted_depth_two(spark, sf):
    """One regularised tree of depth two."""
    return _boosted_scores(spark, sf, num_round=1, max_depth=2)


def _auc_sql(r: int) -> str:
    return f"""a{r} AS (
  SELECT {r} AS round, SUM(pos * (below + neg / 2.0)) / nullif(SUM(pos) * SUM(neg), 0) AS auc FROM (
    SELECT *, coalesce(SUM(neg) OVER (ORDER BY margin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (
      SELECT round(margin, 12) AS margin, SUM(n * y) AS pos, SUM(n * (1 - y)) AS neg FROM m{r} WHERE split = 'val' GROUP BY 1)))"""


@query("boosted_patience", f"""
WITH {FEATURED}, {_boosted_sql(4, 1)}, {', '.join(_auc_sql(r) for r in range(1, 5))},
aucs AS ({' UNION ALL '.join(f'SELECT * FROM a{r}' for r in range(1, 5))}),
best AS (SELECT *, max(auc) OVER (ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM aucs),
last AS (SELECT coalesce(min(round) FILTER (before IS NOT NULL AND auc <= before), 5) - 1 AS kept FROM best)
SELECT CAST(round AS INTEGER) AS round, round(auc, 6) AS auc, round <= kept AS kept FROM aucs, last""")
def boosted_patience(spark, sf):
    """Validation AUC of four stumps from one fit, and the rounds that a patience of one keeps."""
    df = _flag_rows(spark, sf).where("split IN ('train', 'val')").withColumn("is_val", F.col("split") == "val")
    model = bo.train_boosted(df, list(_FLAGS), val_flag="is_val", early_stopping_rounds=1, num_round=4, max_depth=1, **_BOOST)
    kept = len(model.trees)
    rows = [(k, a, k <= kept) for k, a in enumerate(model.auc, 1)]
    return rounded(spark.createDataFrame(rows, "round int, auc double, kept boolean"))


@query("train_score_boosted")
def train_score_boosted(spark, sf):
    """The preset with all regularisation terms on the engineered features: trained with patience on AUC, all splits evaluated side by side."""
    df = add_distance_features(add_temporal_features(labelled(spark, sf)))
    features = FEATURE_SETS["basic"]
    train = df.where("split IN ('train', 'val')").withColumn("is_val", F.col("split") == "val")
    model = bo.train_boosted(train, features, preset="smoothed", val_flag="is_val", num_round=8, max_depth=3, early_stopping_rounds=3)
    kept = pin(bo.score_boosted(model, df).select("split", "probability", "DELAYED"))
    return rounded(mt.evaluate_by(kept, "split", label="DELAYED"))


# ---------------------------------------------------------------- boosting (no SQL twin: a tree learner)


def _trained(spark: SparkSession, sf: str):
    df = add_distance_features(add_temporal_features(labelled(spark, sf)))
    features = FEATURE_SETS["basic"]
    train = df.where("split IN ('train', 'val')").withColumn("is_val", F.col("split") == "val")
    model = ml.train_gbt(
        train, features, preset="baseline", val_flag="is_val", seed=42, partitions=spark.sparkContext.defaultParallelism
    )
    return model, df, features


@query("train_score_gbt")
def train_score_gbt(spark, sf):
    """Train on two splits with early stopping, score all four, evaluate side by side."""
    model, df, _ = _trained(spark, sf)
    # scores are dear and read twice: keep the three columns that are evaluated
    kept = pin(ml.score(model, df).select("split", "probability", "DELAYED"))
    return rounded(mt.evaluate_by(kept, "split", label="DELAYED"))


@query("importances")
def importances(spark, sf):
    model, df, features = _trained(spark, sf)
    return rounded(ml.importances(model, features, df))
