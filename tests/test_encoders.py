"""Learned statistics: values, fallbacks, smoothing limits, leakage, persistence, both join paths."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from latewatch.operators.encoders import KeyStatistics, MedianImputer, StatisticsHistory, TargetEncoding, VolumeEncoding

KEY = {"RATE": "k"}


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame([
        ("a", 1, "train"), ("a", 0, "train"), ("a", 1, "train"), ("b", 0, "train"), (None, 1, "train"),
        ("a", 0, "test"), ("new", 1, "test"), (None, 0, "test"),
    ], "k string, DELAYED int, split string")


@pytest.fixture(scope="module")
def train(data):
    return data.where("split = 'train'")


def test_rates_and_fallbacks(data, train):
    enc = TargetEncoding.fit(train, KEY)
    assert enc.statistics.global_rate == pytest.approx(0.6)  # the row with a NULL key counts
    got = rows(enc.transform(data, seen=True).select("k", "split", "RATE", "RATE_SEEN").distinct())
    assert got == rows(data.sparkSession.createDataFrame([
        ("a", "train", 2 / 3, True), ("b", "train", 0.0, True), (None, "train", 0.6, False),
        ("a", "test", 2 / 3, True), ("new", "test", 0.6, False), (None, "test", 0.6, False),
    ], "k string, s string, r double, seen boolean"))


def test_smoothing_limits(data, train):
    stats = KeyStatistics.fit(train, ["k"])

    def rates(m):
        return {r.k: r.RATE for r in stats.encode(data, KEY, smoothing=m).collect()}

    assert rates(0)["a"] == pytest.approx(2 / 3)
    assert rates(100)["a"] == pytest.approx((2 + 100 * 0.6) / 103)
    assert rates(1e12)["a"] == pytest.approx(0.6)


def test_volume(data, train):
    out = {r.k: r.N for r in VolumeEncoding.fit(train, {"N": "k"}).transform(data).collect()}
    assert out == {"a": pytest.approx(math.log(4)), "b": pytest.approx(math.log(2)), "new": 0.0, None: 0.0}


def test_train_mean_of_the_encoding_is_the_label_mean(train):
    enc = TargetEncoding.fit(train.where("k IS NOT NULL"), KEY)
    r = enc.transform(train.where("k IS NOT NULL")).agg(F.avg("RATE"), F.avg("DELAYED")).first()
    assert r[0] == pytest.approx(r[1])


def test_other_splits_do_not_leak(data):
    def fitted(df):
        return rows(KeyStatistics.fit(df.where("split = 'train'"), ["k"]).table)

    flipped = data.withColumn("DELAYED", F.when(F.col("split") == "train", F.col("DELAYED")).otherwise(1 - F.col("DELAYED")))
    assert fitted(data) == fitted(flipped)


def test_large_tables_are_joined_by_shuffle_with_equal_results(data, train):
    stats = KeyStatistics.fit(train, ["k"])
    small = stats.encode(data, KEY, {"N": "k"})
    large = stats.encode(data, KEY, {"N": "k"}, limit_bytes=0)
    assert rows(small) == rows(large)
    assert small.columns == large.columns == [*data.columns, "RATE", "N"]
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "broadcast" not in plan.lower()


def test_save_and_load(data, train, tmp_path):
    stats = KeyStatistics.fit(train, ["k"])
    stats.save(str(tmp_path / "stats"))
    again = KeyStatistics.load(data.sparkSession, str(tmp_path / "stats"))
    assert (again.positives, again.n) == (stats.positives, stats.n)
    assert rows(again.encode(data, KEY)) == rows(stats.encode(data, KEY))


def test_repartitioning_changes_nothing(data, train):
    assert rows(KeyStatistics.fit(train.repartition(7), ["k"]).table) == rows(KeyStatistics.fit(train.coalesce(1), ["k"]).table)


def test_empty_training_data(data):
    stats = KeyStatistics.fit(data.where("split = 'none'"), ["k"])
    assert stats.global_rate is None
    assert {r.RATE for r in stats.encode(data, KEY).collect()} == {None}


def test_median_imputer(spark):
    df = spark.createDataFrame(
        [("train", 1.0), ("train", 2.0), ("train", None), ("test", 10.0), ("test", None)], "split string, v double")
    one = MedianImputer.fit(df.where("split = 'train'"), "v").transform(df)
    assert rows(one.where("v = 1.5").select("split")) == [("test",), ("train",)]
    per = MedianImputer.fit(df, "v", by="split").transform(df)
    assert rows(per) == [("test", 10.0), ("test", 10.0), ("train", 1.0), ("train", 1.5), ("train", 2.0)]


# ---------------------------------------------------------------- statistics that grow


def _history_rows(spark):
    return spark.range(3000).select(
        F.format_string("2024-01-%02d", F.col("id") % 7 + 1).alias("day"), F.concat(F.lit("A"), F.col("id") * 7 % 11).alias("AIRLINE"),
        F.when(F.col("id") % 13 != 0, F.concat(F.lit("R"), F.col("id") * 31 % 101)).alias("ROUTE"), (F.col("id") * 17 % 5 == 0).cast("int").alias("DELAYED"),
    )


def test_history_equals_a_fit_at_once(spark, tmp_path):
    data = _history_rows(spark)
    same = lambda a, b: rows(a.table) == rows(b.table) and (a.positives, a.n) == (b.positives, b.n)
    history = StatisticsHistory(spark, f"{tmp_path}/h", ["AIRLINE", "ROUTE"])
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        history.add(day, data.where(F.col("day") == day))
    fitted = lambda where: KeyStatistics.fit(data.where(where), ["AIRLINE", "ROUTE"])
    assert same(history.current(), fitted("day <= '2024-01-03'"))
    history.add_all(data.where("day >= '2024-01-03'"), F.col("day"))  # replaces the third day, keeps the first two
    assert same(history.current(), fitted("true"))
    assert same(history.current(since="2024-01-02", until="2024-01-05"), fitted("day BETWEEN '2024-01-02' AND '2024-01-05'"))
    assert history.remove("2024-01-04") and not history.remove("2024-01-04")
    assert same(history.current(), fitted("day <> '2024-01-04'"))
    wrong = data.where("day = '2024-01-06'").withColumn("DELAYED", F.lit(1))
    history.add("2024-01-06", wrong)
    history.add("2024-01-06", data.where("day = '2024-01-06'"))  # added again: replaced, not added up
    assert same(history.current(), fitted("day <> '2024-01-04'"))


def test_history_reads_only_what_it_needs(spark, tmp_path):
    data = _history_rows(spark)
    history = StatisticsHistory(spark, f"{tmp_path}/h", ["AIRLINE"])
    history.add_all(data, F.col("day"))
    recent = history.saved().where("version >= '2024-01-06'")
    assert {f.split("version=")[1][:10] for f in recent.inputFiles()} >= {"2024-01-06", "2024-01-07"}
    assert "PartitionFilters: [isnotnull(version" in recent._jdf.queryExecution().executedPlan().toString()
    out = history.current(since="2024-01-06").encode(data, {"r": "AIRLINE"})
    want = {r.AIRLINE: r.r for r in data.where("day >= '2024-01-06'").groupBy("AIRLINE").agg(F.avg("DELAYED").alias("r")).collect()}
    assert all(r.r == pytest.approx(want[r.AIRLINE]) for r in out.collect())
    for bad in ("", "a/b", "x=1", ".."[:0]):
        with pytest.raises(ValueError):
            history.add(bad, data)
