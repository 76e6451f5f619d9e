"""Plan shape: scans, shuffles, joins, no Python in the hot path; runtime helpers."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import ROOT
from latewatch.operators import metrics as mt
from latewatch.operators.encoders import KeyStatistics
from latewatch.operators.clean import clean_funnel
from latewatch.operators.matrix import non_numeric_columns
from latewatch.operators.monitor import violations
from latewatch.operators.profile import rates_by_each, split_summary
from latewatch.plans.flight_queries import featured
from latewatch.plans.tables import cleaned, flights, labelled, scored
from latewatch.runtime import lookup_join, pin, scratch_path, shared_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("+- == Initial Plan ==")[0]


def test_filters_and_columns_reach_the_scan(spark, sf):
    p = plan(cleaned(spark, sf).select("AIRLINE"))
    line = next(l for l in p.splitlines() if "l_partkey" in l and "FileScan" in l)
    assert "l_extendedprice" not in line and "PushedFilters: [IsNotNull" in line


def test_fitting_scans_the_rows_once(spark, sf):
    keys = ["AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "ROUTE", "DEP_HOUR"]
    train = featured(spark, sf).where("split = 'train'")
    grouped = train.groupingSets([[F.col(k)] for k in keys] + [[]], *[F.col(k) for k in keys]).agg(F.count("*"))
    assert plan(grouped).count("l_orderkey") and plan(grouped).count("Expand") == 1
    assert sum("FileScan" in l and "l_orderkey" in l for l in plan(grouped).splitlines()) == 1


def test_encoding_moves_no_fact_row(spark, sf):
    df = featured(spark, sf)
    stats = KeyStatistics.fit(df.where("split = 'train'"), ["ROUTE", "AIRLINE"])
    p = plan(stats.encode(df, {"A": "AIRLINE", "R": "ROUTE"}, {"N": "ROUTE"}))
    assert p.count("LeftOuter") == 2  # one lookup per key, shared by its features
    assert "SortMergeJoin" not in p and "Exchange hashpartitioning" not in p


def test_one_pass_profiles(spark, sf):
    assert sum("FileScan" in l and "l_orderkey" in l for l in plan(clean_funnel(flights(spark, sf))).splitlines()) == 1
    p = plan(rates_by_each(flights(spark, sf), ["MONTH", "DAY_OF_WEEK"]))
    assert sum("FileScan" in l and "l_orderkey" in l for l in p.splitlines()) == 1
    p = plan(split_summary(labelled(spark, sf)))
    assert sum("FileScan" in l and "l_orderkey" in l for l in p.splitlines()) == 1 and "Subquery" not in p


def test_curves_reuse_the_counts_and_never_sort_raw_rows(spark, sf):
    p = final_plan(mt.pr_curve(scored(spark, sf), ["version"]))
    assert "FileScan" not in p  # the input was read once, for the counts, which are written


def test_auc_needs_no_join(spark, sf):
    p = plan(mt.evaluate(scored(spark, sf), by=["version"]))
    assert "Join" not in p and "FileScan" not in p  # the input was read once, for the counts


def test_only_range_totals_meet_in_one_task(spark, sf):
    p = plan(mt.evaluate(scored(spark, sf)))
    lines = p.splitlines()
    single = [i for i, l in enumerate(lines) if "SinglePartition" in l]
    assert single and all("_range" in lines[i + 1] or "Aggregate" in lines[i + 1] for i in single)


def test_samples_of_all_columns_come_from_one_scan(spark, sf):
    p = plan(non_numeric_columns(featured(spark, sf)))
    assert sum("FileScan" in l and "l_orderkey" in l for l in p.splitlines()) == 1
    assert p.count("WindowGroupLimit") == 2  # before and after the shuffle


def test_constraints_are_only_mapped(spark):
    metrics = spark.range(3).select("id", *[F.rand().alias(n) for n in mt.METRIC_NAMES])
    cons = spark.createDataFrame([("auc", 0.5, "LessThanThreshold")], "metric string, threshold double, comparison_operator string")
    assert "Exchange hashpartitioning" not in plan(violations(metrics, cons, ["id"]))


def test_source_has_no_forbidden_calls():
    for path in glob.glob(os.path.join(ROOT, "latewatch", "**", "*.py"), recursive=True):
        if f"{os.sep}llm{os.sep}" in path:
            continue
        text = open(path).read()
        for bad in ("localCheckpoint", "crossJoin", ".toPandas(", "inferSchema", ".rdd", "@F.udf", "pandas_udf"):
            assert bad not in text, (path, bad)


def test_pin_uses_the_configured_folder(spark):
    folder = shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{folder}/**/part-*", recursive=True))
    df = pin(spark.range(10).repartition(2))
    assert set(glob.glob(f"{folder}/**/part-*", recursive=True)) - before
    assert "ExistingRDD" in plan(df) and df.count() == 10
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_cluster_without_shared_folder_is_refused():
    class Conf(dict):
        def get(self, k, d=None):
            return dict.get(self, k, d)

    class Sc:
        master = "yarn"
        getConf = staticmethod(Conf)
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Sc()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_lookup_join_keeps_rows_on_both_paths(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id").withColumn("k", F.when(F.col("id") != 7, F.col("k")))
    table = spark.createDataFrame([(0, "zero"), (1, "one")], "k long, v string")
    for size in (10, 1 << 40):
        out = lookup_join(df, table, ["k"], size)
        assert out.count() == 100 and out.where("v IS NULL").count() == 34


def test_scratch_is_removed(spark):
    from latewatch.runtime import clean_scratch, scratch_path

    clean_scratch(spark)
    paths = [scratch_path(spark, f"gone{k}") for k in range(3)]
    for p in paths[:2]:  # one is never written
        spark.range(3).write.parquet(p)
    assert clean_scratch(spark) == 3 and not any(os.path.exists(p) for p in paths) and clean_scratch(spark) == 0


def test_lookups_share_one_broadcast_budget(spark):
    names = [f"k{i}" for i in range(7)]
    df = spark.range(2000).select((F.col("id") % 2).cast("int").alias("DELAYED"), *[F.concat(F.lit(n), F.col("id").cast("string")).alias(n) for n in names])
    stats = KeyStatistics.fit(df, names)
    one = max(stats.bytes_per_key.values())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # else the planner broadcasts tables as small as these anyway
    try:
        p = plan(stats.encode(df, {f"{n}_RATE": n for n in names}, limit_bytes=3 * one))
        assert p.count("BroadcastHashJoin") == 3 and p.count("SortMergeJoin") == 4
        assert plan(stats.encode(df, {f"{n}_RATE": n for n in names})).count("BroadcastHashJoin") == 7
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
