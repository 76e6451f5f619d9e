"""All-or-nothing writes: a killed task leaves the old output, leftovers go, torn outputs are seen and redone, by every writer."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from latewatch.sources import manifest as mf
from latewatch.sources import readers, writers


@pytest.fixture()
def good(spark):
    return spark.range(400).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("DELAYED"), F.when(F.col("id") < 200, "train").otherwise("val").alias("split"))


def broken(df):
    """The same rows, but the task with the last ones dies after the others have written theirs."""

    @F.udf("double")
    def die(x):
        if x > 395:
            raise RuntimeError("killed")
        return x

    return df.repartition(4, "x").withColumn("x", die("x"))


def scored(df):
    return df.select(F.col("x").alias("probability"), F.lit(1).alias("prediction"), F.col("DELAYED").alias("label"))


WRITERS = {
    "splits": lambda df, p, how: writers.write_splits(df, p, ["x", "DELAYED"], if_exists=how),
    "matrix": lambda df, p, how: writers.write_matrix_csv(df, p, ["x"], if_exists=how),
    "matrix of a split": lambda df, p, how: writers.write_matrix_csv(df, p, ["x"], splits=["val"], if_exists=how),
    "features": lambda df, p, how: writers.write_features(df, p, how),
    "report": lambda df, p, how: writers.write_report(df, p, how),
    "scored": lambda df, p, how: writers.write_scored(scored(df), p, how),
    "inference": lambda df, p, how: writers.write_inference_input(df, p, ["x"], if_exists=how),
    "truth": lambda df, p, how: writers.write_ground_truth_table(
        df.select(F.col("x").cast("string").alias("id"), F.col("DELAYED").alias("label"), F.timestamp_seconds(F.lit(0)).alias("at")), p, "at", if_exists=how),
}


@pytest.mark.parametrize("name", WRITERS)
def test_aborted_write_keeps_the_old_output_and_is_redone(spark, good, tmp_path, name):
    write, path = WRITERS[name], f"{tmp_path}/out"
    target = f"{path}/validation" if name == "matrix of a split" else path
    read = lambda: rows(spark.read.option("recursiveFileLookup", True).text(target) if name != "features" else spark.read.parquet(target))
    with pytest.raises(Exception, match="killed"):
        write(broken(good), path, "skip")
    assert not os.path.exists(target) or not os.listdir(target)
    write(good, path, "skip")
    first = read()
    assert mf.finished(spark, target) and len(first) >= 200
    with pytest.raises(Exception, match="killed"):
        write(broken(good.withColumn("DELAYED", F.lit(1))), path, "overwrite")
    assert read() == first and mf.finished(spark, target)
    write(good.withColumn("DELAYED", F.lit(1)), path, "skip")
    assert read() == first
    write(good.where("x >= 200").withColumn("DELAYED", F.lit(1)), path, "overwrite")
    assert read() != first and mf.finished(spark, target)
    parent = os.path.dirname(target)
    assert [f for f in os.listdir(parent) if ".staged" in f or ".old" in f] == []


def test_torn_outputs_are_seen(spark, good, tmp_path):
    path = f"{tmp_path}/m"
    writers.write_features(good, path)
    files = mf.read_manifest(spark, path)["files"]
    assert files and all(os.path.getsize(f"{path}/{f}") == n for f, n in files.items())
    assert mf.assert_complete(spark, path) == path and readers.read_features(spark, path).count() == 400
    part = f"{path}/{sorted(files)[0]}"
    kept = open(part, "rb").read()
    for content in (kept[:-1], None):
        os.remove(part) if content is None else open(part, "wb").write(content)
        assert not mf.finished(spark, path)
        with pytest.raises(FileNotFoundError):
            mf.assert_complete(spark, path)
    writers.write_features(good, path, "skip")
    assert mf.finished(spark, path)
    open(f"{path}/split=val/part-other.parquet", "wb").write(kept)
    assert not mf.finished(spark, path)


def test_outputs_without_a_manifest(spark, good, tmp_path):
    good.write.parquet(f"{tmp_path}/plain")
    assert mf.finished(spark, f"{tmp_path}/plain") and mf.read_manifest(spark, f"{tmp_path}/plain") is None
    assert not mf.publish(good, f"{tmp_path}/plain", "parquet", "skip")
    assert not mf.finished(spark, f"{tmp_path}/nothing")


def test_death_between_the_two_renames(spark, good, tmp_path):
    """The old output has been moved aside and the new one not put in place: the next call brings the old one back."""
    path = f"{tmp_path}/r"
    writers.write_report(good, path)
    before = rows(spark.read.json(path))
    os.rename(path, f"{tmp_path}/.r.old-1")
    os.mkdir(f"{tmp_path}/.r.staged-2")
    mf.recover(spark, path)
    assert rows(spark.read.json(path)) == before and sorted(os.listdir(tmp_path)) == ["r"]
    # and after the second one: the new output stays, the old one goes
    os.mkdir(f"{tmp_path}/.r.old-3")
    assert not mf.publish(good, path, "json", "skip") and sorted(os.listdir(tmp_path)) == ["r"]


def test_policies(spark, good, tmp_path):
    path = f"{tmp_path}/p"
    writers.write_report(good, path, "error")
    with pytest.raises(FileExistsError):
        writers.write_report(good, path, "error")
    with pytest.raises(ValueError):
        writers.write_report(good, path, "maybe")
    writers.write_report(good, path, "append")
    assert spark.read.json(path).count() == 800
    writers.write_report(good.limit(0), path, "overwrite")
    assert mf.finished(spark, path)
