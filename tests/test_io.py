"""Readers, writers and the catalog: round trips and error cases."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from latewatch.functions import whole_number
from latewatch.operators import gate as gt
from latewatch.operators import metrics as mt
from latewatch.schemas import AIRLINE_COLUMNS, FLIGHT_COLUMNS, SPLIT_COLUMNS, matrix_schema, schema_of
from latewatch.sources import catalog, readers, writers


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def _flight_line(**values):
    return ",".join(str(values.get(c, "")) for c in FLIGHT_COLUMNS)


def test_read_flights_accepts_decimal_whole_numbers(spark, tmp_path):
    header = ",".join(FLIGHT_COLUMNS)
    lines = [
        _flight_line(YEAR=2015, MONTH=1, AIRLINE="AA", SCHEDULED_DEPARTURE=930, DEPARTURE_TIME="930.0", ARRIVAL_DELAY=-3.5),
        _flight_line(YEAR=2015, MONTH="x", AIRLINE="BB"),
    ]
    path = _write(f"{tmp_path}/flights.csv", "\n".join([header, *lines]) + "\n")
    df = readers.read_flights(spark, path, keep_corrupt=True).cache()
    assert df.columns == [*FLIGHT_COLUMNS, "_corrupt_record"]
    good, bad = df.orderBy("AIRLINE").collect()
    assert (good.DEPARTURE_TIME, good.ARRIVAL_DELAY, good.TAIL_NUMBER, good._corrupt_record) == (930, -3.5, None, None)
    assert bad.MONTH is None and bad._corrupt_record.startswith("2015,x")
    plain = readers.read_flights(spark, path)
    assert plain.columns == list(FLIGHT_COLUMNS)
    assert {f.name: f.dataType.simpleString() for f in plain.schema} == FLIGHT_COLUMNS
    assert readers.preview(plain, 1).count() == 1


def test_lookups(spark, tmp_path):
    path = _write(f"{tmp_path}/airlines.csv", "IATA_CODE,AIRLINE\nAA,\"American, Inc.\"\n")
    assert rows(readers.read_airlines(spark, path)) == [("AA", "American, Inc.")]
    path = _write(f"{tmp_path}/airports.csv",
                  "IATA_CODE,AIRPORT,CITY,STATE,COUNTRY,LATITUDE,LONGITUDE\nABE,A,B,PA,USA,40.6,oops\n")
    r = readers.read_airports(spark, path).first()
    assert (r.LATITUDE, r.LONGITUDE) == (40.6, None)


@pytest.fixture(scope="module")
def clean(spark):
    data = [(1, 2, 3, 930, "AA", "JFK", "LAX", 100.0, 60.0, 1, "train"), (10, 2, 3, 5, "AA", "JFK", "LAX", 100.0, 60.0, 0, "val"),
            (11, 2, 3, 5, "BB", "JFK", "LAX", 100.0, 60.0, 0, "test")]
    return spark.createDataFrame(data, ", ".join(f"{c} {t}" for c, t in SPLIT_COLUMNS.items()) + ", split string")


def test_splits_round_trip_in_both_layouts(spark, clean, tmp_path):
    path = str(tmp_path / "splits")
    writers.write_splits(clean, path)
    assert rows(readers.read_splits(spark, path)) == rows(clean)  # prod is optional
    with pytest.raises(FileNotFoundError, match="prod"):
        readers.read_splits(spark, path, optional=())
    header = ",".join(SPLIT_COLUMNS)
    for name in ("train", "val", "test"):
        _write(f"{tmp_path}/flat/{name}.csv", f"{header}\n1,2,3,930,AA,JFK,LAX,100.0,60.0,1\n")
    assert readers.read_splits(spark, f"{tmp_path}/flat").groupBy("split").count().count() == 3
    with pytest.raises(FileNotFoundError):
        readers.read_splits(spark, f"{tmp_path}/none", optional=("train", "val", "test", "prod"))


FEATURES = ["MONTH", "DISTANCE"]


def test_matrix_round_trip_and_skip(spark, clean, tmp_path):
    path = str(tmp_path / "matrix")
    writers.write_matrix_csv(clean, path, FEATURES, splits=["train", "val", "test"])
    assert sorted(os.listdir(path)) == ["test", "train", "validation"]
    back = readers.read_matrix_csv(spark, f"{path}/validation", FEATURES)
    assert rows(back) == [(0, 10, 100.0)] and back.schema == matrix_schema(FEATURES)
    tree = readers.read_tree(spark, path, "csv", matrix_schema(FEATURES))
    assert rows(tree) == rows(clean.select("DELAYED", *FEATURES))
    writers.write_matrix_csv(clean.withColumn("DISTANCE", F.lit(0.0)), path, FEATURES, splits=["train"], if_exists="skip")
    assert rows(readers.read_matrix_csv(spark, f"{path}/train", FEATURES)) == [(1, 1, 100.0)]
    with pytest.raises(ValueError, match="AIRLINE"):
        writers.write_matrix_csv(clean, path, ["AIRLINE"])


def test_tree_errors_and_nesting(spark, clean, tmp_path):
    os.makedirs(f"{tmp_path}/empty/deep")
    with pytest.raises(FileNotFoundError):
        readers.read_tree(spark, f"{tmp_path}/empty", "csv", schema_of({"a": "int"}))
    with pytest.raises(FileNotFoundError):
        readers.read_tree(spark, f"{tmp_path}/empty", "parquet")
    with pytest.raises(ValueError):
        readers.read_tree(spark, f"{tmp_path}/empty", "csv")
    for part in ("a", "b/c"):
        clean.select(*FEATURES).write.parquet(f"{tmp_path}/tree/{part}")
    _write(f"{tmp_path}/tree/readme.txt", "not data")
    assert readers.read_tree(spark, f"{tmp_path}/tree", "parquet").count() == 6


def test_features_partition_and_prune(spark, clean, tmp_path):
    path = str(tmp_path / "features")
    writers.write_features(clean, path)
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["split=test", "split=train", "split=val"]
    assert any(f.endswith(".snappy.parquet") for f in os.listdir(f"{path}/split=val"))
    df = readers.read_features(spark, path, ["split", "DISTANCE"]).where("split = 'val'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "ReadSchema: struct<DISTANCE:double>" in plan
    assert df.count() == 1


def test_inference_input(spark, clean, tmp_path):
    path = str(tmp_path / "inference")
    writers.write_inference_input(clean, path, FEATURES, n=2, order_by="MONTH")
    assert rows(readers.read_matrix_csv(spark, path, FEATURES, label=None)) == [(1, 100.0), (10, 100.0)]
    with pytest.raises(ValueError, match="order"):
        writers.write_inference_input(clean, path, FEATURES, n=2)


def test_predictions(spark, tmp_path):
    path = _write(f"{tmp_path}/out/test.csv.out", "0.25\n0.5\n0.75\n")
    assert rows(readers.read_predictions(spark, path)) == [(0.25, 0), (0.5, 1), (0.75, 1)]


def test_scored_header(spark, tmp_path):
    path = str(tmp_path / "scored")
    df = spark.createDataFrame([(0.7, 1, 0, "x")], "probability double, prediction int, label int, id string")
    writers.write_scored(df.coalesce(1), path)
    part = next(f for f in os.listdir(path) if f.endswith(".csv"))
    assert open(f"{path}/{part}").read() == "probability,prediction,label\n0.7,1,0\n"


def _one_json(path):
    part = next(f for f in os.listdir(path) if f.endswith(".json"))
    return json.loads(open(f"{path}/{part}").read())


def test_reports_as_json(spark, tmp_path):
    df = spark.createDataFrame([(0.7, 1), (0.6, 0), (0.1, 0)], "probability double, label int")
    writers.write_report(mt.evaluation_report(mt.evaluate(df)).coalesce(1), f"{tmp_path}/evaluation")
    doc = _one_json(f"{tmp_path}/evaluation")
    assert list(doc["metrics"]) == ["accuracy", "precision", "recall", "f1_score", "auc"]
    assert doc["metrics"]["auc"]["value"] == 1.0
    assert doc["confusion_matrix"] == {"true_negative": 1, "false_positive": 1, "false_negative": 0, "true_positive": 1}
    writers.write_report(gt.rejection_report(mt.evaluate(df), 0.9).coalesce(1), f"{tmp_path}/rejection")
    doc = _one_json(f"{tmp_path}/rejection")
    assert set(doc) == {"rejection_timestamp", "rejection_reason", "threshold", "model_metrics", "status", "recommendations"}
    assert doc["recommendations"] == list(gt.ADVICE_ALWAYS)


def test_ground_truth_layouts(spark, tmp_path):
    df = spark.createDataFrame([("0", 1), ("1", 0)], "id string, label int")
    at = dt.datetime(2024, 3, 4, 5, 6, 7, tzinfo=dt.timezone.utc)
    path = writers.write_ground_truth(df, f"{tmp_path}/truth", at)
    assert path.endswith("/2024/03/04/05/0607.jsonl")
    later = df.withColumn("at", F.lit("2024-03-05 06:30:17.25").cast("timestamp"))
    writers.write_ground_truth_table(later, f"{tmp_path}/truth", "at")
    got = rows(readers.read_ground_truth(spark, f"{tmp_path}/truth"))
    first, second = dt.datetime(2024, 3, 4, 5, 6, 7), dt.datetime(2024, 3, 5, 6, 30, 17, 250_000)
    assert got == sorted([("0", 1, first), ("1", 0, first), ("0", 1, second), ("1", 0, second)], key=repr)
    _write(f"{tmp_path}/one/2024/01/02/03/0405.jsonl",
           '{"groundTruthData":{"data":"1","encoding":"CSV"},"eventMetadata":{"eventId":"7"},"eventVersion":"0"}\n')
    assert rows(readers.read_ground_truth(spark, f"{tmp_path}/one")) == [("7", 1, dt.datetime(2024, 1, 2, 3, 4, 5))]


def test_external_tables(spark, tmp_path):
    catalog.ensure_database(spark, "lw_test")
    catalog.ensure_database(spark, "lw_test")
    _write(f"{tmp_path}/airlines/a.csv", "IATA_CODE;AIRLINE\nAA;'American; Inc.'\nBB;7.0\n")
    for _ in range(2):  # the second call replaces the table
        raw = catalog.register_external(spark, "lw_test.airlines", f"{tmp_path}/airlines", AIRLINE_COLUMNS, sep=";", quote="'")
    assert rows(raw) == [("AA", "American; Inc."), ("BB", "7.0")]
    assert spark.sql("SELECT * FROM lw_test.airlines LIMIT 1").count() == 1
    assert rows(catalog.table_counts(spark, ["lw_test.airlines"])) == [("lw_test.airlines", 2)]
    kinds = {"IATA_CODE": "string", "AIRLINE": "int"}
    assert rows(catalog.typed_view(raw, kinds)) == [("AA", None), ("BB", 7)]
    assert rows(catalog.bad_casts(raw, kinds)) == [("AIRLINE", 1), ("IATA_CODE", 0)]
    catalog.drop_table(spark, "lw_test.airlines")
    assert not spark.catalog.tableExists("lw_test.airlines")
    assert os.path.exists(f"{tmp_path}/airlines/a.csv")  # external: the data stay


def test_truth_matches_after_a_round_trip(spark, tmp_path):
    """Scored at 10:20, truth at 10:40:33: the pair is there before and after the upload, whatever the session's zone."""
    from latewatch.operators.monitor import join_ground_truth

    scored = spark.createDataFrame([("a", dt.datetime(2024, 3, 1, 10, 20), 0.7)], "id string, ts timestamp, probability double")
    truth = spark.createDataFrame([("a", 1, dt.datetime(2024, 3, 1, 10, 40, 33))], "id string, label int, at timestamp")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for k, name in enumerate(("UTC", "America/New_York", "Asia/Kolkata")):
            spark.conf.set("spark.sql.session.timeZone", name)
            writers.write_ground_truth_table(truth, f"{tmp_path}/{k}", "at")
            back = readers.read_ground_truth(spark, f"{tmp_path}/{k}")
            assert join_ground_truth(scored, back).count() == 1
            assert back.select(F.unix_micros("truth_ts")).first()[0] == truth.select(F.unix_micros("at")).first()[0]
            assert os.path.isdir(f"{tmp_path}/{k}/upload_date=2024-03-01/upload_hour=10")
            path = writers.write_ground_truth(truth, f"{tmp_path}/one{k}", dt.datetime(2024, 3, 4, 5, 6, 7, tzinfo=dt.timezone.utc))
            assert path.endswith("/2024/03/04/05/0607.jsonl")
            seconds = readers.read_ground_truth(spark, f"{tmp_path}/one{k}").select(F.unix_seconds("truth_ts")).first()[0]
            assert seconds == int(dt.datetime(2024, 3, 4, 5, 6, 7, tzinfo=dt.timezone.utc).timestamp())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_flight_cells_that_do_not_fit(spark, tmp_path):
    from latewatch.schemas import FLIGHT_COLUMNS

    def line(**cells):
        return ",".join(cells.get(c, "1" if t == "int" else "") for c, t in FLIGHT_COLUMNS.items()) + "\n"

    cells = ["930.0", "930.5", "NaN", "99999999999", "-99999999999", "Infinity", "x", ""]
    _write(f"{tmp_path}/f.csv", ",".join(FLIGHT_COLUMNS) + "\n" + "".join(line(DISTANCE=c, SCHEDULED_DEPARTURE=c) for c in cells))
    got = [r.SCHEDULED_DEPARTURE for r in readers.read_flights(spark, f"{tmp_path}/f.csv").collect()]
    assert got == [930, None, None, None, None, None, None, None]


def test_skip_writes_what_an_aborted_write_left(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, "train"), (0, 3.0, "val")], "DELAYED int, x double, split string")
    os.makedirs(f"{tmp_path}/m/train/_temporary")
    for _ in range(2):
        writers.write_matrix_csv(df, f"{tmp_path}/m", ["x"], splits=["train", "val"], if_exists="skip")
        assert rows(readers.read_tree(spark, f"{tmp_path}/m", "csv", matrix_schema(["x"]))) == [(0, 3.0), (1, 2.0)]


def test_whole_numbers_are_exact(spark):
    cells = {
        "9007199254740993": 9007199254740993, "-9223372036854775808": -(2**63), "9223372036854775807": 2**63 - 1, "9223372036854775808": None, "12.5": None, "NaN": None,
        "930.0": 930, "930.000": 930, "1e3": 1000, "-7": -7, "": None, "x": None, " 12 ": 12, "Infinity": None, "0.0001": None, "12 345": None, "1e400": None, "-0.0": 0,
    }
    df = spark.createDataFrame([(c, v) for c, v in cells.items()] + [(None, None)], "t string, want bigint")
    got = df.select("t", "want", whole_number("t", "bigint").alias("big"), whole_number(F.col("t")).alias("small"))
    for r in got.collect():
        assert r.big == r.want, r.t
        assert r.small == (r.want if r.want is not None and abs(r.want) < 2**31 else None), r.t
    bad = {r["column"]: r.n_bad for r in catalog.bad_casts(df.select(F.col("t").alias("a"), F.col("t").alias("b")), {"a": "bigint", "b": "int"}).collect()}
    assert bad == {"a": sum(v is None for v in cells.values()), "b": sum(v is None or abs(v) >= 2**31 for v in cells.values())}
