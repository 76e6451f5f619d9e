"""Streams against their batch twins, late truth, scoring on the way in, restarts."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from latewatch.operators import model as ml
from latewatch.operators import monitor as mo
from latewatch.operators.metrics import binary_metrics
from latewatch.operators.splits import capture_sample
from latewatch.plans import QUERIES, io_queries
from latewatch.schemas import schema_of
from latewatch.sources import readers, writers
from latewatch.streaming import join_streams, quality_stream, run_available, scored_stream, truth_stream


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Four days, 60 rows an hour apart in minutes; truth follows at the next hour, every 10th two days later."""
    root = str(tmp_path_factory.mktemp("streams"))
    base = 1704067200
    all_rows = spark.range(4 * 24 * 6).select(
        F.col("id").cast("string").alias("id"), F.timestamp_seconds(F.lit(base) + F.col("id") * 600).alias("ts"),
        ((F.col("id") * 37 % 100) / 100).alias("probability"), (F.col("id") * 13 % 3 == 0).cast("int").alias("label"),
        F.col("id").alias("n"),
    )
    all_rows.select("id", "ts", "probability").repartition(3).write.json(f"{root}/scored")
    delay = F.when(F.col("n") % 10 == 0, 48).otherwise(1)
    truth = all_rows.withColumn("at", F.date_trunc("hour", "ts") + F.make_dt_interval(hours=delay))
    writers.write_ground_truth_table(truth, f"{root}/truth", "at")
    return root


def _batch(spark, root, max_delay, every):
    scored = spark.read.schema("id string, ts timestamp, probability double").json(f"{root}/scored")
    joined = mo.join_ground_truth(scored, readers.read_ground_truth(spark, f"{root}/truth"), max_delay)
    return binary_metrics(joined.withColumn("window_start", F.window("ts", every)["start"]), by=["window_start"])


@pytest.mark.parametrize("salts", [1, 4])
def test_stream_equals_batch_on_closed_windows(spark, folders, tmp_path, salts):
    stream = quality_stream(
        scored_stream(spark, f"{folders}/scored"), truth_stream(spark, f"{folders}/truth"), "6 hours", "6 hours", salts=salts)
    run_available(stream, f"{tmp_path}/out", f"{tmp_path}/state")
    got = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")
    cols = ["window_start", "true_negative", "false_positive", "false_negative", "true_positive", "f1_score"]
    want = {r[0]: tuple(r) for r in _batch(spark, folders, "6 hours", "6 hours").select(*cols).collect()}
    seen = [tuple(r) for r in got.select(*cols).collect()]
    assert len(seen) == len({r[0] for r in seen}) >= 12  # every closed window once
    assert all(want[r[0]] == r for r in seen)
    n = sum(sum(r[1:5]) for r in seen)
    assert n == len(seen) * 36 - sum(1 for i in range(len(seen) * 36) if i % 10 == 0)  # late truth is left out


def test_rerun_adds_nothing(spark, folders, tmp_path):
    def run():
        stream = quality_stream(
            scored_stream(spark, f"{folders}/scored"), truth_stream(spark, f"{folders}/truth"), "6 hours", "6 hours")
        run_available(stream, f"{tmp_path}/out", f"{tmp_path}/state")
        return rows(spark.read.schema(stream.schema).parquet(f"{tmp_path}/out"))

    assert run() == run()


def test_join_has_both_watermarks_and_a_time_range(spark, folders):
    j = join_streams(scored_stream(spark, f"{folders}/scored"), truth_stream(spark, f"{folders}/truth"), "6 hours")
    plan = j._jdf.queryExecution().analyzed().toString()
    assert plan.count("EventTimeWatermark") == 2 and "truth_ts" in plan and j.isStreaming


def test_features_are_scored_on_the_way_in(spark, tmp_path):
    df = spark.range(200).select(
        F.col("id").cast("string").alias("id"), F.timestamp_seconds(F.col("id")).alias("ts"),
        (F.col("id") % 10).cast("double").alias("a"), (F.col("id") % 10 > 4).cast("int").alias("y"))
    model = ml.train_gbt(df, ["a"], "y", num_round=2, max_depth=2, seed=1)
    df.drop("y").write.json(f"{tmp_path}/in")
    schema = schema_of({"id": "string", "ts": "timestamp", "a": "double"})
    stream = capture_sample(scored_stream(spark, f"{tmp_path}/in", schema, model=model), 50, "id")
    run_available(stream.select("id", "probability"), f"{tmp_path}/out", f"{tmp_path}/state")
    got = rows(spark.read.parquet(f"{tmp_path}/out"))
    assert got == rows(capture_sample(ml.score(model, df), 50, "id").select("id", "probability"))


def test_summary_runs_on_a_stream(spark, folders, tmp_path):
    s = mo.stream_summary(scored_stream(spark, f"{folders}/scored"), "1 day", label=None)
    run_available(s, f"{tmp_path}/out", f"{tmp_path}/state")
    closed = rows(spark.read.schema(s.schema).parquet(f"{tmp_path}/out"))
    batch = spark.read.schema("id string, ts timestamp, probability double").json(f"{folders}/scored")
    assert set(closed) < set(rows(mo.stream_summary(batch, "1 day", label=None))) and len(closed) == 3


def test_state_is_on_disk_whatever_the_session_says(spark, folders, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(key)
    spark.conf.set(key, heap)
    try:
        stream = quality_stream(
            scored_stream(spark, f"{folders}/scored"), truth_stream(spark, f"{folders}/truth"), "6 hours", "6 hours")
        query = run_available(stream, f"{tmp_path}/out", f"{tmp_path}/state", state_partitions=2)
        assert spark.conf.get(key) == heap
    finally:
        spark.conf.set(key, before)
    operators = query.lastProgress["stateOperators"]
    assert len(operators) == 3 and all("rocksdbPutCount" in o["customMetrics"] for o in operators)
    assert not [f for f in (tmp_path / "state").rglob("*.delta")]


def test_quality_of_many_rows_is_streamed_in_slices_of_time(spark, tmp_path, monkeypatch):
    """Forty days, one file in no order, with a time that is missing, rows that come twice and an id without truth: slices give the rows of one run, and
    the state of the join never holds more than a part of them."""
    n = 2400
    events = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 301 != 7, F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("id") * 1009, F.lit(n)) * 1440)).cast("timestamp_ntz").alias("ts"),
        (F.col("id") * 31 % 97).alias("user_id"), F.when(F.col("id") % 5 == 0, "error").otherwise("view").alias("event_type"),
        (F.col("id") * 17 % 1000 / 100).alias("value"), F.lit("{}").alias("props"))
    events.union(events.where("event_id % 50 = 3")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    runs = []

    def run(*args, **kwargs):
        runs.append(run_available(*args, **kwargs))
        return runs[-1]

    def held(queries):
        """The most rows that the state of the join has at the end of a batch."""
        now, most = 0, 0
        for progress in (p for q in queries for p in q.recentProgress if p["stateOperators"]):
            join = next(o for o in progress["stateOperators"] if o["operatorName"] == "symmetricHashJoin")
            now += join["numRowsUpdated"] - join["numRowsRemoved"]
            most = max(most, now)
        return most

    monkeypatch.setattr(io_queries, "run_available", run)
    want = rows(QUERIES["stream_quality"](spark, str(tmp_path)))
    whole = held(runs)
    runs.clear()
    monkeypatch.setattr(io_queries, "_SLICE_ROWS", 240, raising=False)
    got = rows(QUERIES["stream_quality"](spark, str(tmp_path)))
    assert got == want and len(got) == 40
    assert len(runs) > 5 and 0 < held(runs) < whole / 3
