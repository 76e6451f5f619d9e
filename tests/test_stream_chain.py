"""Streams that build on each other: latest match, coverage, quality with AUC, alarm; in several batches, with restarts, against batch results."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import rows
from latewatch.operators import metrics as mt
from latewatch.operators import monitor as mo
from latewatch.schemas import schema_of
from latewatch.sources import readers, writers
from latewatch.streaming import (
    alarm_stream, close_input, close_truth, coverage_stream, match_stream, matches_stream, run_available, scored_stream, status_stream, truth_stream,
    window_quality_stream,
)
from latewatch.streaming.streams import SCORED_SCHEMA, auc_of_cells

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
ENDS = (datetime(2030, 1, 1, tzinfo=timezone.utc), datetime(2031, 1, 1, tzinfo=timezone.utc))
MATCHES = schema_of({"id": "string", "ts": "timestamp", "probability": "double", "truth_ts": "timestamp", "label": "int"})


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Six files of half a day each. Thirty ids restart every three hours; truth comes after minutes, after many hours, or never."""
    root = str(tmp_path_factory.mktemp("chain"))
    rng = random.Random(5)
    for part in range(6):
        scored, labels = [], []
        for run in range(4):
            at = START + timedelta(hours=12 * part + 3 * run)
            for i in range(30):
                ts = at + timedelta(seconds=rng.randrange(3600))
                scored.append((str(i), ts, rng.randrange(1000) / 1000))
                kind = rng.random()
                if kind < 0.8:
                    wait = timedelta(minutes=rng.randrange(1, 60)) if kind < 0.6 else timedelta(hours=rng.randrange(2, 9), seconds=rng.randrange(999))
                    labels.append((str(i), rng.randrange(2), ts + wait))
        scored += scored[:2]  # equal rows
        labels += labels[:2]
        spark.createDataFrame(scored, SCORED_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/scored")
        truth = spark.createDataFrame(labels, "id string, label int, at timestamp")
        writers.write_ground_truth_table(truth, f"{root}/truth", "at", by_hour=False)
    for at in ENDS:
        close_input(spark, f"{root}/scored", SCORED_SCHEMA, at)
        close_truth(spark, f"{root}/truth", at)
    return root


def scored_rows(spark, root):
    return spark.read.schema(SCORED_SCHEMA).parquet(f"{root}/scored").where("id <> ''")


def batch_matches(spark, root, delay):
    truth = readers.read_ground_truth(spark, f"{root}/truth").where("id <> ''")
    return mo.join_ground_truth(scored_rows(spark, root), truth, delay)


def match(spark, root, out, files=None):
    stream = match_stream(
        scored_stream(spark, f"{root}/scored", fmt="parquet", max_files_per_trigger=files),
        truth_stream(spark, f"{root}/truth", max_files_per_trigger=files), "12 hours", salts=2)
    assert stream.columns == batch_matches(spark, root, "12 hours").columns
    return run_available(stream, f"{out}/matches", f"{out}/state", state_partitions=2)


@pytest.fixture(scope="module")
def matched(spark, folders, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("matched"))
    query = match(spark, folders, out)
    return out, query


def test_latest_match_equals_batch(spark, folders, matched):
    out, query = matched
    got = spark.read.schema(MATCHES).parquet(f"{out}/matches").where("id <> ''")
    want = batch_matches(spark, folders, "12 hours").select(got.columns)
    assert rows(got) == rows(want) and want.count() > 400
    # ids are used every three hours, so many truth rows lie in the range of several scored rows
    pairs = mo.join_ground_truth(scored_rows(spark, folders), readers.read_ground_truth(spark, f"{folders}/truth"), "12 hours", latest_only=False)
    assert pairs.count() > 2 * want.count()


def test_state_is_bounded_and_restart_adds_nothing(spark, folders, matched):
    out, query = matched
    # the watermark has passed all but the closing rows, and the state has let go of everything else
    left = {o.operatorName: o.numRowsTotal for o in query.recentProgress[-1].stateOperators}
    assert left["stateStoreSave"] <= 2 and left["symmetricHashJoin"] <= 8
    before = rows(spark.read.schema(MATCHES).parquet(f"{out}/matches"))
    again = match(spark, folders, out)
    assert rows(spark.read.schema(MATCHES).parquet(f"{out}/matches")) == before
    assert sum(p.numInputRows for p in again.recentProgress) == 0


def test_small_batches_lose_nothing_in_order(spark, folders, tmp_path):
    """One file at a time: batches and watermarks advance in steps, all matches come out once."""
    query = match(spark, folders, str(tmp_path), files=1)
    assert len({p.batchId for p in query.recentProgress if p.numInputRows}) > 5
    got = spark.read.schema(MATCHES).parquet(f"{tmp_path}/matches").where("id <> ''")
    have, want = Counter(map(tuple, got.collect())), Counter(map(tuple, batch_matches(spark, folders, "12 hours").select(got.columns).collect()))
    assert max(have.values()) == 1 and not have - want
    # a file of one side may be a day behind the other: what is late for the watermark of an hour is dropped, and said to be
    dropped = sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)
    assert have == want or dropped > 0


def plain_status(scored, truth, delay, wait):
    """First truth of each scored row that is the latest before it, by a double loop."""
    first = {}
    for i, label, at in set(truth):
        earlier = [s for s in scored if s[0] == i and s[1] <= at <= s[1] + wait]
        if earlier:
            s = max(earlier, key=lambda s: (s[1], s[2]))
            first[s] = min(first.get(s, at), at)
    return {s: ("unmatched" if s not in first else "matched" if first[s] <= s[1] + delay else "late") for s in scored}


def test_status_and_coverage(spark, folders, matched, tmp_path):
    out, _ = matched

    def inputs():
        return scored_stream(spark, f"{folders}/scored", fmt="parquet"), matches_stream(spark, f"{out}/matches", MATCHES, "12 hours")

    status = status_stream(*inputs(), "1 hour")
    run_available(status, f"{tmp_path}/status", f"{tmp_path}/s1", state_partitions=2)
    got = spark.read.schema(status.schema).parquet(f"{tmp_path}/status").where("id <> ''")
    scored = [tuple(r) for r in scored_rows(spark, folders).collect()]
    truth = [tuple(r) for r in readers.read_ground_truth(spark, f"{folders}/truth").select("id", "label", "truth_ts").where("id <> ''").collect()]
    want = plain_status(scored, truth, timedelta(hours=1), timedelta(hours=12))
    assert sorted((r.id, r.ts, r.probability, r.status) for r in got.collect()) == sorted((*s, want[s]) for s in scored)
    assert {"matched", "late", "unmatched"} == set(want.values())

    covered = coverage_stream(*inputs(), "6 hours", "1 hour")
    run_available(covered, f"{tmp_path}/cover", f"{tmp_path}/s2", state_partitions=2)
    windows = defaultdict(Counter)
    for s in scored:
        windows[s[1].replace(hour=s[1].hour // 6 * 6, minute=0, second=0, microsecond=0)][want[s]] += 1
    seen = spark.read.schema(covered.schema).parquet(f"{tmp_path}/cover").collect()
    assert {r.window_start: (r.n_scored, r.n_matched, r.n_late, r.n_unmatched) for r in seen} == {
        w: (sum(c.values()), c["matched"], c["late"], c["unmatched"]) for w, c in windows.items()}
    run_available(coverage_stream(*inputs(), "6 hours", "1 hour"), f"{tmp_path}/cover", f"{tmp_path}/s2", state_partitions=2)
    assert spark.read.schema(covered.schema).parquet(f"{tmp_path}/cover").count() == len(seen)


def test_quality_with_auc(spark, folders, matched, tmp_path):
    out, _ = matched
    stream = window_quality_stream(matches_stream(spark, f"{out}/matches", MATCHES, "12 hours"), "6 hours")
    run_available(stream, f"{tmp_path}/q", f"{tmp_path}/s", state_partitions=2)
    got = spark.read.schema(stream.schema).parquet(f"{tmp_path}/q")
    want = mo.evaluate_windows(batch_matches(spark, folders, "12 hours"), "6 hours")
    assert [r.auc_error for r in got.collect()] == [0.0] * want.count()
    rounded = lambda df: rows(df.select([F.round(c, 9).alias(c) if t == "double" else c for c, t in want.dtypes]))
    assert rounded(got.select(want.columns)) == rounded(want)


@pytest.mark.parametrize("cells", [1, 7, 50, 1000])
def test_auc_error_is_a_bound(spark, cells):
    """Scores of many digits: the exact AUC lies within the stated error, which shrinks with the number of cells."""
    rng = random.Random(8)
    data = [(START + timedelta(minutes=i % 180), rng.betavariate(2, 5) if i % 3 else rng.betavariate(4, 3), int(i % 3 == 0)) for i in range(3000)]
    data += [(START, 1.5, 1), (START, -0.5, 0), (START, None, 1), (START, 0.5, None), (START + timedelta(days=1), 0.4, 1)]
    df = spark.createDataFrame(data, "ts timestamp, probability double, label int")
    exact = {r.window_start: r for r in mo.evaluate_windows(df, "1 hour").collect()}
    got = {r.window_start: r for r in window_quality_stream(df, "1 hour", cells=cells).collect()}
    assert got.keys() == exact.keys()
    for w, r in got.items():
        assert (r.true_positive, r.false_positive, r.true_negative, r.false_negative) == tuple(
            exact[w][c] for c in ("true_positive", "false_positive", "true_negative", "false_negative"))
        if exact[w].auc is None:
            assert r.auc is None and r.auc_error is None
        else:
            assert abs(r.auc - exact[w].auc) <= r.auc_error + 1e-12 and r.auc_error <= max(0.5, 1 / cells)
    if cells == 1000:
        assert max(r.auc_error for r in got.values() if r.auc is not None) < 0.002


def test_cells_of_ties(spark):
    df = spark.createDataFrame([([(1, 2, 3, 0.1, 0.1), (0, 1, 1, 0.0, 0.05)],)], "c array<struct<cell:int,pos:long,neg:long,low:double,high:double>>")
    r = df.select(auc_of_cells(F.col("c")).alias("x")).first().x
    assert r.auc == pytest.approx((1 * 1 / 2 + 2 * 1 + 2 * 3 / 2) / 12) and r.auc_error == pytest.approx(0.5 / 12)
    one_class = spark.createDataFrame([([(1, 2, 0, 0.1, 0.1)],)], df.schema)
    assert one_class.select(auc_of_cells(F.col("c")).alias("x")).first().x.auc is None


METRICS = schema_of({"window_start": "timestamp", "version": "int", "f1_score": "double"})


@pytest.mark.parametrize("policy", ["breaching", "notBreaching", "missing"])
def test_alarm_equals_batch(spark, tmp_path, policy):
    """Gaps, several metrics in a period, NULL metrics, a group that starts late; in three batches."""
    rng = random.Random(1)
    data = []
    for k in range(90):
        at = START + timedelta(minutes=10 * k)
        for v in (0, 1):
            if rng.random() < 0.35 and (v == 0 or k > 20):
                data.append((at + timedelta(seconds=rng.randrange(600)), v, rng.choice([0.1, 0.2, 0.3, 0.5, None])))
    for part in range(3):
        spark.createDataFrame([d for k, d in enumerate(data) if k * 3 // len(data) == part], METRICS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/m")
    end = START + timedelta(days=1)
    close_input(spark, f"{tmp_path}/m", METRICS, end, "window_start")  # version 0: a value of its own, at the end
    source = spark.readStream.schema(METRICS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/m").withWatermark("window_start", "30 minutes")
    stream = alarm_stream(source, 1200, 0.25, policy, ["version"])

    def run():
        run_available(stream, f"{tmp_path}/out", f"{tmp_path}/state", state_partitions=2)
        return rows(spark.read.schema(stream.schema).parquet(f"{tmp_path}/out"))

    got = run()
    assert len(got) == len({r[:2] for r in got})
    batch = mo.alarm(spark.createDataFrame(data, METRICS), 1200, 0.25, policy, ["version"])
    want = [tuple(r) for r in batch.select("version", "period_start", F.round("average", 9), "in_alarm").collect()]
    last = {v: max(r[1] for r in want if r[0] == v) for v in (0, 1)}
    plain = lambda r: (r[0], r[1], None if r[2] is None else round(r[2], 9), r[3])
    assert sorted(map(plain, (r for r in got if r[1] <= last[r[0]])), key=repr) == sorted(want, key=repr)
    # after its last metric a group goes on without data until the watermark
    no_data = {"breaching": True, "notBreaching": False, "missing": None}[policy]
    after = [r for r in got if r[1] > last[r[0]]]
    assert {(r[2], r[3]) for r in after} == {(None, no_data)}
    assert max(r[1] for r in after) == (end - timedelta(hours=1)).replace(tzinfo=None)  # the watermark is half an hour behind; 20 minutes have passed by then
    assert run() == got


def test_alarm_of_all_rows(spark, tmp_path):
    data = [(START + timedelta(minutes=30 * k), 0, 0.1 + 0.2 * (k % 3)) for k in range(10)]
    spark.createDataFrame(data, METRICS).write.parquet(f"{tmp_path}/m")
    stream = alarm_stream(spark.readStream.schema(METRICS).parquet(f"{tmp_path}/m").withWatermark("window_start", "0 seconds"), 1800, 0.2)
    run_available(stream, f"{tmp_path}/out", f"{tmp_path}/state", state_partitions=1)
    got = [(r.period_start, r.in_alarm) for r in spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").orderBy("period_start").collect()]
    assert stream.columns == ["period_start", "average", "in_alarm"]
    assert got == [(d[0].replace(tzinfo=None), d[2] <= 0.2) for d in data[:-1]]
    with pytest.raises(ValueError):
        alarm_stream(stream, treat_missing="x")


def test_batch_evaluation_agrees(spark):
    """The cell counts are the same whether read as a stream or as a table."""
    df = spark.range(500).selectExpr("timestamp_seconds(1704067200 + id * 60) AS ts", "(id * 37 % 100) / 100D AS probability", "int(id * 13 % 3 = 0) AS label")
    got = window_quality_stream(df, "1 day", 0.4).first()
    want = mt.evaluate(df, 0.4).first()
    assert got.auc == pytest.approx(want.auc) and got.f1_score == pytest.approx(want.f1_score)


def test_match_of_a_dense_id_joins_pieces_not_rows(spark, tmp_path):
    """One id, 3,000 scored and 3,000 truth rows within the delay: the join sees a few gathered rows, and the matches are those of the batch."""
    base = F.lit(1704067200)
    scored = spark.range(3000).select(F.lit("0").alias("id"), F.timestamp_seconds(base + F.col("id") * 20).alias("ts"), (F.col("id") % 7 / 7).alias("probability"))
    truth = spark.range(3000).select(F.lit("0").alias("id"), (F.col("id") % 2).cast("int").alias("label"), F.timestamp_seconds(base + F.col("id") * 20 + 9).alias("at"))
    scored.write.parquet(f"{tmp_path}/scored")
    writers.write_ground_truth_table(truth, f"{tmp_path}/truth", "at", by_hour=False)
    want = batch_matches(spark, str(tmp_path), "12 hours")
    want = rows(want.select("id", "ts", "probability", "truth_ts", "label"))
    for at in ENDS:
        close_input(spark, f"{tmp_path}/scored", SCORED_SCHEMA, at)
        close_truth(spark, f"{tmp_path}/truth", at)
    query = match(spark, str(tmp_path), str(tmp_path))
    assert rows(spark.read.schema(MATCHES).parquet(f"{tmp_path}/matches").where("id <> ''")) == want and len(want) == 3000
    assert sum(o.numRowsUpdated for p in query.recentProgress for o in p.stateOperators if o.operatorName == "symmetricHashJoin") <= 100
