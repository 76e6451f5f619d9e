"""Order statistics and splits against brute force, with ties, skew, NULLs and different partitionings."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from latewatch.operators import ranges as rg
from latewatch.operators import splits as sp
from latewatch.operators.profile import median


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one value; one group is NULL; some values are NULL."""
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        v = 0.5 if i % 3 == 0 else (None if i % 50 == 1 else rnd.expovariate(1000.0))
        data.append((("a", "b", None)[i % 3 if i % 7 else 2], v, i))
    return spark.createDataFrame(data, "g string, v double, i int").repartition(5)


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.77, 1.0])
def test_exact_quantile_equals_numpy(skewed, q):
    values = [r.v for r in skewed.collect() if r.v is not None]
    assert rg.exact_quantile(skewed, "v", q).first()[0] == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_exact_quantile_per_group_with_null_group(skewed):
    want = {}
    for r in skewed.where("v IS NOT NULL").collect():
        want.setdefault(r.g, []).append(r.v)
    got = {r.g: r.v_q for r in rg.exact_quantile(skewed, "v", 0.3, ["g"]).collect()}
    assert set(got) == set(want)
    for g, vs in want.items():
        assert got[g] == pytest.approx(np.quantile(vs, 0.3), rel=1e-12)


def test_cuts_are_ascending_bounded_and_follow_the_weight(spark):
    df = spark.range(20000).select((F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e12).alias("v")).repartition(7)
    cuts = rg.range_edges(df, "v")
    fine = rg.finer(cuts)
    assert cuts == sorted(set(cuts)) and len(cuts) < rg.MIN_RANGES
    assert fine == sorted(set(fine)) and set(cuts) <= set(fine) and len(fine) <= len(cuts) * rg.SUBDIVISIONS
    largest = rg.with_range(df, "v", cuts).groupBy(rg.RANGE).count().agg(F.max("count")).first()[0]
    assert largest < 3 * 20000 / rg.MIN_RANGES
    order = rg.with_range(df, "v", fine).orderBy("v").select(rg.RANGE).collect()
    assert [r[0] for r in order] == sorted(r[0] for r in order)
    assert rg.range_edges(df.where("v < 0"), "v") == []


def test_quantile_of_any_cuts_is_the_same(skewed):
    """Cuts only balance the work; the result does not depend on them."""
    a = rg.exact_quantile(skewed, "v", 0.5, edges=[]).first()[0]
    b = rg.exact_quantile(skewed, "v", 0.5, edges=[1e-5, 2.0, 3.0]).first()[0]
    assert a == b == rg.exact_quantile(skewed, "v", 0.5).first()[0]


def test_median_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    assert median(empty, "v").first()[0] is None
    assert median(spark.createDataFrame([(1.0,), (2.0,)], "v double"), "v").first()[0] == 1.5
    assert median(spark.createDataFrame([(1.0,), (2.0,)], "v double"), "v", exact=False).first()[0] == 1.0


def test_quantile_falls_back_to_a_shuffled_join(skewed, monkeypatch):
    want = rows(rg.exact_quantile(skewed, "v", 0.5, ["g"]))
    monkeypatch.setattr(rg, "BROADCAST_LIMIT_BYTES", 0)
    assert rows(rg.exact_quantile(skewed, "v", 0.5, ["g"])) == want


@pytest.mark.parametrize("descending", [True, False])
def test_prefix_sums_equal_a_plain_window(skewed, descending):
    counts = skewed.where("v IS NOT NULL").groupBy("g", "v").agg(F.count("*").alias("n"), F.sum("i").alias("s"))
    cut = rg.with_range(counts, "v", rg.range_edges(counts, "v"))
    got = rg.prefix_sums(cut, "v", ["n", "s"], ["g"], descending)
    order = F.desc("v") if descending else F.asc("v")
    w = Window.partitionBy("g").orderBy(order)
    whole = Window.partitionBy("g")
    want = counts.select(
        "g", "v", F.sum("n").over(w), F.sum("s").over(w), F.sum("n").over(whole), F.lead("n").over(w), F.lead("s").over(w))
    cols = ["g", "v", "n_upto", "s_upto", "n_all", "n_next", "s_next"]
    assert rows(got.select(*cols)) == rows(want)


def test_temporal_split_covers_each_month_once(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 13)] + [(None,), (13,)], "MONTH int")
    got = {r.MONTH: r.split for r in sp.temporal_split(df).collect()}
    assert [got[m] for m in (1, 9, 10, 11, 12)] == ["train", "train", "val", "test", "prod"]
    assert got[None] is None and got[13] is None


def _label_frame(spark, n=2000):
    return spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(n)], "id int, label int")


def test_stratified_split_has_exact_sizes(spark):
    df = _label_frame(spark)
    out = sp.stratified_split(df, "label", "id")
    assert rows(out.groupBy("label", "split").count()) == rows(spark.createDataFrame([
        (0, "train", 640), (0, "val", 160), (0, "test", 160), (0, "prod", 640),
        (1, "train", 160), (1, "val", 40), (1, "test", 40), (1, "prod", 160)], "l int, s string, n long"))
    assert out.count() == out.select("id").distinct().count() == 2000


def test_stratified_split_ignores_partitioning_and_obeys_the_seed(spark):
    df = _label_frame(spark, 300)
    one = rows(sp.stratified_split(df, "label", "id", seed=1))
    assert rows(sp.stratified_split(df.repartition(7), "label", "id", seed=1)) == one
    assert rows(sp.stratified_split(df, "label", "id", seed=2)) != one


def test_stratified_split_keeps_copies_together_and_null_labels_in(spark):
    df = spark.createDataFrame([(7, 1)] * 500 + [(i, 1) for i in range(100, 600)] + [(i, None) for i in range(50)], "id int, label int")
    out = sp.stratified_split(df, "label", "id")
    assert out.count() == 1050
    assert out.where("id = 7 AND label = 1").select("split").distinct().count() == 1
    assert out.where("label IS NULL").groupBy("split").count().where("split = 'train'").first()["count"] == 20


def test_hash_split_and_sample_are_nested(spark):
    df = _label_frame(spark)
    cheap = sp.stratified_split(df, "label", "id", exact=False).groupBy("split").count().collect()
    assert {r.split for r in cheap} == {"train", "val", "test", "prod"}
    few, more = (set(r.id for r in sp.capture_sample(df, p, "id").collect()) for p in (10, 40))
    assert few < more
    assert abs(len(more) / 2000 - 0.4) < 0.05
    assert sp.capture_sample(df, 100, "id").count() == 2000
    assert sp.capture_sample(df, 0, "id").count() == 0


def test_bad_fractions(spark):
    with pytest.raises(ValueError):
        sp.stratified_split(_label_frame(spark, 10), "label", "id", {"a": 0.5, "b": 0.4})


def test_first_n(spark):
    assert [r.id for r in sp.first_n(_label_frame(spark).repartition(6), 3, "id").collect()] == [0, 1, 2]
