"""Cleaning, funnel, exploration on small frames."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from latewatch.operators import clean as cl
from latewatch.operators import profile as pf
from latewatch.operators.lookups import missing, with_names
from latewatch.operators.matrix import (
    assert_numeric, non_numeric_columns, non_numeric_names, select_matrix, split_xy,
)

RAW = "CANCELLED int, DIVERTED int, ARRIVAL_DELAY double, SCHEDULED_TIME double, DISTANCE double, AIRLINE string"


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([
        (0, 0, 20.0, 100.0, 500.0, "A"), (0, 0, 15.0, 100.0, 500.0, "A"), (1, 0, None, 100.0, 500.0, "B"),
        (0, 1, 30.0, 100.0, 500.0, "B"), (0, 0, None, 100.0, 500.0, "B"), (0, 0, 16.0, None, 500.0, None),
        (0, 0, 1.0, 90.0, None, "B"),
    ], RAW)


def test_clean_variants(raw):
    assert cl.clean(raw).count() == 2
    assert cl.clean(raw, required=cl.REQUIRED_RANDOM).count() == 3


def test_funnel_agrees_with_clean(raw):
    assert [tuple(r) for r in cl.clean_funnel(raw).orderBy("step_no").collect()] == [
        (0, "raw", 7, 0), (1, "operated", 5, 2), (2, "has_arrival_delay", 4, 1), (3, "has_inputs", 2, 2)]


def test_label_drops_its_source(raw):
    out = cl.with_label(cl.clean(raw))
    assert "ARRIVAL_DELAY" not in out.columns
    assert sorted(r.DELAYED for r in out.collect()) == [0, 1]


def test_target_summary_counts_nulls_apart(raw):
    r = pf.target_summary(raw).first()
    assert (r.total, r.delayed, r.on_time, r.missing) == (7, 3, 2, 2)
    assert r.imbalance == pytest.approx(2 / 3)


def test_rates_keep_null_delays_in_the_denominator(raw):
    assert [(r.AIRLINE, r.n, r.rate) for r in pf.rate_by(raw, "AIRLINE").collect()] == [("A", 2, 50.0), ("B", 4, 25.0)]
    skipping = {r.AIRLINE: r.rate for r in pf.rate_by(raw, "AIRLINE", null_as_false=False).collect()}
    assert skipping["B"] == 50.0


def test_rates_by_each_total_counts_null_keys(raw):
    out = {(r.dimension, r.value): r.n for r in pf.rates_by_each(raw, ["AIRLINE", "CANCELLED"]).collect()}
    assert out == {("AIRLINE", "A"): 2, ("AIRLINE", "B"): 4, ("CANCELLED", "0"): 6, ("CANCELLED", "1"): 1, ("overall", None): 7}


def test_counts_and_top_k_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    assert [tuple(r) for r in pf.top_k(df, "v", 2).collect()] == [("c", 2), ("a", 1)]
    assert pf.value_counts(df, "v").count() == 3
    assert [r.v for r in pf.distinct_values(df, "v").collect()] == ["a", "b", "c"]
    assert pf.n_distinct(df, ["v"]).first()[0] == 3
    assert pf.n_distinct(df, ["v"], approximate=True).first()[0] == 3


def test_missing_profile(raw):
    assert {r.column: (r.n_missing, r.pct_missing) for r in pf.missing_profile(raw, ["AIRLINE", "DISTANCE", "DIVERTED"]).collect()} == {
        "AIRLINE": (1, 14.29), "DISTANCE": (1, 14.29), "DIVERTED": (0, 0.0)}


def test_histogram_puts_the_maximum_in_the_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)] + [(None,)], "v double")
    assert [r.n for r in pf.histogram(df, "v", 5).orderBy("bin").collect()] == [2, 2, 2, 2, 3]
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert sum(r.n for r in pf.histogram(same, "v", 4).collect()) == 2
    assert pf.histogram(df.where("v IS NULL"), "v", 4).count() == 0


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "DELAYED int")
    assert pf.pos_weight(df).first().pos_weight == 9.0
    assert pf.pos_weight(df, cap=3.0).first().pos_weight == 3.0
    assert pf.pos_weight(df.where("DELAYED = 0"), cap=3.0).first().pos_weight is None


def test_verify_splits_flags_nulls_and_schemas(spark):
    a = spark.createDataFrame([(1.0, 1), (2.0, 0)], "x double, DELAYED int")
    b = spark.createDataFrame([(None, 1)], "x double, DELAYED int")
    c = spark.createDataFrame([(1, 1.0)], "DELAYED int, x double")
    out = {r.split: (r.n, r.n_missing, r.status, r.schema_matches)
           for r in pf.verify_split_frames({"train": a, "val": b, "test": c}).collect()}
    assert out == {"train": (2, 0, "OK", True), "val": (1, 1, "WARNING", True), "test": (1, 0, "OK", False)}


def test_split_summary_percent_adds_up(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), ("b", 1)], "split string, DELAYED int")
    out = {r.split: (r.n, r.pct, r.delay_rate) for r in pf.split_summary(df).collect()}
    assert out == {"a": (2, 50.0, 50.0), "b": (2, 50.0, 100.0)}


def test_names_fall_back_to_the_code(spark):
    df = spark.createDataFrame([("AA",), ("ZZ",), (None,)], "AIRLINE string")
    lookup = spark.createDataFrame([("AA", "American Airlines Incorporated")], "IATA_CODE string, AIRLINE string")
    assert rows(with_names(df, lookup, "AIRLINE").select("AIRLINE", "name")) == rows(spark.createDataFrame(
        [("AA", "American Airlines Incorpo"), ("ZZ", "ZZ"), (None, None)], "a string, b string"))


def test_missing(spark):
    want = spark.createDataFrame([("a",), ("b",), ("b",)], "f string")
    have = spark.createDataFrame([("a",), ("a",), ("c",)], "f string")
    assert rows(missing(want, have, "f")) == [("b",)]


def test_matrix_checks(spark):
    df = spark.createDataFrame([(1, 2.0, "z"), (0, 3.0, "y")], "DELAYED int, a double, s string")
    assert non_numeric_names(df) == ["s"]
    assert rows(non_numeric_columns(df)) == [("s", "string", "y"), ("s", "string", "z")]
    assert non_numeric_columns(df.drop("s")).count() == 0
    with pytest.raises(ValueError, match="s"):
        assert_numeric(df)
    x, y = split_xy(assert_numeric(df.drop("s")))
    assert (x.columns, y.columns) == (["a"], ["DELAYED"])
    assert select_matrix(df, ["a"]).columns == ["DELAYED", "a"]
    assert cl.drop_cols(df, "s").columns == ["DELAYED", "a"]


def test_rates_sorted_descending(raw):
    rates = [r.rate for r in pf.rate_by(raw.withColumn("k", F.col("ARRIVAL_DELAY")), "k").collect()]
    assert rates == sorted(rates, reverse=True)


def test_sketches_merge_without_the_rows(spark, tmp_path):
    """Sketches of parts, stored and merged, estimate as the sketch of everything does, within three standard errors."""
    df = spark.range(60_000).select(
        (F.col("id") % 12).cast("int").alias("m"), (F.col("id") % 2).alias("g"), (F.col("id") * 7 % 9973).alias("a"), F.concat(F.lit("x"), F.col("id") % 40).alias("b"),
        ((F.col("id") % 500) / 10).alias("c"), F.when(F.col("id") < 0, 1).alias("nothing"),
    )
    names = ["a", "b", "c", "nothing"]
    pf.distinct_sketches(df, names, ["m", "g"]).write.parquet(f"{tmp_path}/s")
    stored = spark.read.parquet(f"{tmp_path}/s")
    whole = pf.sketch_counts(pf.merge_sketches(stored, names), names).first()
    exact = pf.n_distinct(df, names).first()
    bound = 3 * 1.04 / 2 ** (pf.SKETCH_BITS / 2)
    for c in names:
        assert abs(whole[f"{c}_distinct"] - exact[f"{c}_distinct"]) <= bound * exact[f"{c}_distinct"] + 0.5
    by = {r.g: r for r in pf.sketch_counts(pf.merge_sketches(stored, names, ["g"]), names, ["g"]).collect()}
    assert {g: r.b_distinct for g, r in by.items()} == {0: 20, 1: 20} and whole.b_distinct == 40  # a union, not a sum
    assert pf.merge_sketches(stored.limit(0), names, ["g"]).count() == 0
