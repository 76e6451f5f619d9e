"""Registered queries that write, read back and stream; files go to a fresh path in the shared folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch.functions import truth_path, truth_time
from latewatch.operators import gate as gt
from latewatch.operators import metrics as mt
from latewatch.operators import monitor as mo
from latewatch.operators.profile import prediction_summary
from latewatch.operators.matrix import add_distance_features, add_temporal_features, select_matrix
from latewatch.plans.model_queries import _ACC, _F1, _FOUR, _PREC, _REC, _RUNS, _evaluate_ctes, _printed, _runs
from latewatch.plans.registry import query, rounded
from latewatch.plans.tables import FEATURED, FLIGHTS, LABELLED, SCORED, TRUTH, flights, labelled, scored, table, truth
from latewatch.runtime import pin, scratch_path
from latewatch.schemas import AIRPORT_COLUMNS, FEATURE_SETS, FLIGHT_COLUMNS, matrix_schema, schema_of
from latewatch.sources import catalog, readers, writers
from latewatch.sources.manifest import assert_complete, finished, publish
from latewatch.streaming import (
    alarm_stream, close_input, close_truth, coverage_stream, match_stream, matches_stream, quality_stream, run_available, scored_stream, truth_stream,
    window_quality_stream,
)

# ---------------------------------------------------------------- files

_FLIGHT_PART = [
    "YEAR", "MONTH", "DAY", "DAY_OF_WEEK", "AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "SCHEDULED_DEPARTURE",
    "SCHEDULED_TIME", "DISTANCE", "ARRIVAL_DELAY", "CANCELLED", "DIVERTED",
]
# The other columns are made from the day of the month. On some days whole numbers are cells that do not fit.
_OTHERS = [c for c in FLIGHT_COLUMNS if c not in _FLIGHT_PART]
_ODD_CELLS = {3: "NaN", 5: "99999999999", 7: "x", 9: "12.5"}


def _other_cell(name: str):
    """Text of a cell as it stands in the file."""
    k, kind = _OTHERS.index(name), FLIGHT_COLUMNS[name]
    if kind == "string":
        return F.concat(F.lit("N"), (F.col("DAY") + k).cast("string"))
    if kind == "double":
        return F.when(F.col("DAY") != 4, ((F.col("DAY") * 3 + k) / 2).cast("string"))
    cell = F.concat((F.col("DAY") * 10 + k).cast("string"), F.lit(".0"))
    for day, text in _ODD_CELLS.items():
        cell = F.when(F.col("DAY") == day, text).otherwise(cell)
    return cell


def _other_sql(name: str) -> str:
    k, kind = _OTHERS.index(name), FLIGHT_COLUMNS[name]
    if kind == "string":
        return f"""'N' || ("DAY" + {k}) AS "{name}\""""
    if kind == "double":
        return f"""CASE WHEN "DAY" <> 4 THEN ("DAY" * 3 + {k}) / CAST(2 AS DOUBLE) END AS "{name}\""""
    return f"""CAST(CASE WHEN "DAY" NOT IN ({', '.join(map(str, _ODD_CELLS))}) THEN "DAY" * 10 + {k} END AS INTEGER) AS "{name}\""""


def _raw_csv(spark: SparkSession, sf: str) -> str:
    """Flights in the full raw layout; departure hours print as ``930.0``."""
    df = flights(spark, sf).withColumn("SCHEDULED_DEPARTURE", F.col("SCHEDULED_DEPARTURE").cast("double"))
    path = scratch_path(spark, "flights-csv")
    df.select(*[
        F.col(c) if c in _FLIGHT_PART else _other_cell(c).alias(c) for c in FLIGHT_COLUMNS
    ]).write.option("header", True).csv(path)
    return path


_ALL_SQL = ", ".join(f'"{c}"' if c in _FLIGHT_PART else _other_sql(c) for c in FLIGHT_COLUMNS)


@query("io_flights_csv", f"WITH {FLIGHTS} SELECT {_ALL_SQL} FROM flights")
def io_flights_csv(spark, sf):
    """All 31 columns, with cells that do not parse, are no numbers, too large or fractions."""
    return readers.read_flights(spark, _raw_csv(spark, sf))


@query("io_external_table", f"""
WITH {FLIGHTS} SELECT 'external' AS kind, COUNT(*) AS n, COUNT("SCHEDULED_TIME") AS n_time,
  round(AVG("ARRIVAL_DELAY"), 6) AS mean_delay, SUM("SCHEDULED_DEPARTURE")::BIGINT AS departures FROM flights""")
def io_external_table(spark, sf):
    """All-text external table over the CSV, typed on the way out."""
    catalog.ensure_database(spark, "latewatch_io", scratch_path(spark, "database"))
    raw = catalog.register_external(spark, "latewatch_io.flights", _raw_csv(spark, sf), FLIGHT_COLUMNS)
    typed = catalog.typed_view(raw, FLIGHT_COLUMNS)
    return rounded(typed.agg(
        F.lit("external").alias("kind"), F.count("*").alias("n"), F.count("SCHEDULED_TIME").alias("n_time"),
        F.avg("ARRIVAL_DELAY").alias("mean_delay"), F.sum("SCHEDULED_DEPARTURE").alias("departures"),
    ).select("kind", "n", "n_time", "mean_delay", "departures"))


@query("io_bad_casts", """
SELECT 'LATITUDE' AS "column", COUNT(*) FILTER (c_custkey % 10 = 3) AS n_bad FROM customer
UNION ALL SELECT 'LONGITUDE', CAST(0 AS BIGINT)
UNION ALL SELECT 'SMALL', COUNT(*) FILTER (c_custkey % 7 = 1) FROM customer
UNION ALL SELECT 'LARGE', COUNT(*) FILTER (c_custkey % 7 = 2) FROM customer
UNION ALL SELECT 'EXACT', CAST(0 AS BIGINT)
UNION ALL SELECT 'FRACTION', COUNT(*) FILTER (c_custkey % 7 IN (3, 4, 5)) FROM customer""")
def io_bad_casts(spark, sf):
    text = F.when(F.col("c_custkey") % 10 == 3, "unknown").otherwise(F.col("c_custkey").cast("string"))
    path = scratch_path(spark, "bad-casts")
    number = F.concat(F.col("c_custkey").cast("string"), F.lit(".0"))
    small = F.when(F.col("c_custkey") % 7 == 1, "3000000000").otherwise(number)  # too large for an int
    large = F.when(F.col("c_custkey") % 7 == 2, "12 345").when(F.col("c_custkey") % 7 == 1, "3000000000").otherwise(number)
    table(spark, sf, "customer").select(
        text.alias("LATITUDE"), F.lit("1.5").alias("LONGITUDE"), small.alias("SMALL"), large.alias("LARGE"), *_exact_texts()
    ).write.csv(path)
    columns = {"LATITUDE": "double", "LONGITUDE": "double", "SMALL": "int", "LARGE": "bigint", "EXACT": "bigint", "FRACTION": "int"}
    return catalog.bad_casts(catalog.register_external(spark, "lw_bad_casts", path, list(columns), header=False), columns)


def _exact_texts():
    """Integers that no double holds, and numbers that are not whole, not numbers, too large, or whole in another form."""
    n = F.col("c_custkey")
    odd = F.when(n % 7 == 3, "12.5").when(n % 7 == 4, "NaN").when(n % 7 == 5, "1e12").when(n % 7 == 6, F.concat(n.cast("string"), F.lit("e1")))
    return (n + 9007199254740992).cast("string").alias("EXACT"), F.coalesce(odd, F.concat(n.cast("string"), F.lit(".000"))).alias("FRACTION")


@query("io_exact_numbers", """
SELECT c_custkey + 9007199254740992 AS "EXACT",
  CAST(CASE c_custkey % 7 WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN c_custkey * 10 ELSE c_custkey END AS INTEGER) AS "FRACTION"
FROM customer""")
def io_exact_numbers(spark, sf):
    """Whole numbers of text as they are, all others NULL."""
    path = scratch_path(spark, "exact-numbers")
    table(spark, sf, "customer").select(*_exact_texts()).write.csv(path)
    columns = {"EXACT": "bigint", "FRACTION": "int"}
    return catalog.typed_view(catalog.register_external(spark, "lw_exact_numbers", path, list(columns), header=False), columns)


@query("io_lookup_csv", f"""
SELECT c_name AS "IATA_CODE", c_mktsegment AS "AIRPORT",
  CASE WHEN c_custkey % 10 <> 3 THEN CAST(c_custkey AS DOUBLE) END AS "LATITUDE", c_acctbal AS "LONGITUDE"
FROM customer""")
def io_lookup_csv(spark, sf):
    """A lookup file with coordinates that do not all parse."""
    path = scratch_path(spark, "lookup-csv")
    values = {
        "IATA_CODE": F.col("c_name"), "AIRPORT": F.col("c_mktsegment"),
        "LATITUDE": F.when(F.col("c_custkey") % 10 == 3, "unknown").otherwise(F.col("c_custkey").cast("string")),
        "LONGITUDE": F.col("c_acctbal").cast("string"),
    }
    table(spark, sf, "customer").select(*[
        values.get(c, F.lit("")).alias(c) for c in AIRPORT_COLUMNS
    ]).write.option("header", True).csv(path)
    return readers.read_airports(spark, path).select(*values)


@query("io_splits_csv", f"WITH {LABELLED} SELECT * FROM labelled")
def io_splits_csv(spark, sf):
    path = scratch_path(spark, "splits-csv")
    writers.write_splits(labelled(spark, sf), path)
    return readers.read_splits(spark, path)


def _basic(spark: SparkSession, sf: str) -> DataFrame:
    return add_distance_features(add_temporal_features(labelled(spark, sf)))


_RAW_SQL = ", ".join(f'"{c}"' for c in FEATURE_SETS["raw"])


@query("io_matrix_csv", f"""
WITH {FEATURED} SELECT "DELAYED", {_RAW_SQL} FROM featured WHERE split IN ('train', 'val', 'test', 'prod')""")
def io_matrix_csv(spark, sf):
    """Headerless matrices in one folder per split, read back as one tree. A second write skips what exists."""
    path = scratch_path(spark, "matrix-csv")
    for _ in range(2):
        writers.write_matrix_csv(_basic(spark, sf), path, "raw", splits=["train", "val", "test", "prod"], if_exists="skip")
    return readers.read_tree(spark, path, "csv", matrix_schema(FEATURE_SETS["raw"]))


@query("io_features_parquet", f"""
WITH {FEATURED} SELECT "DEP_HOUR", "DISTANCE", "DELAYED" FROM featured WHERE split = 'val'""")
def io_features_parquet(spark, sf):
    """Partitioned features; the reader touches one split and three columns."""
    path = scratch_path(spark, "features")
    writers.write_features(_basic(spark, sf), path)
    wanted = readers.read_features(spark, path, ["split", "DEP_HOUR", "DISTANCE", "DELAYED"])
    return wanted.where("split = 'val'").drop("split")


@query("io_features_back", f"""
WITH {FEATURED} SELECT split, "DELAYED", {_RAW_SQL} FROM featured""")
def io_features_back(spark, sf):
    """Every split of the partitioned features."""
    path = scratch_path(spark, "features")
    writers.write_features(select_matrix(_basic(spark, sf), "raw", keep=["split"]), path)
    return readers.read_features(spark, path)


@query("io_inference_subset", """
SELECT o_orderkey AS key, o_totalprice AS price FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 250""")
def io_inference_subset(spark, sf):
    """The first rows in an order, written and read back (a top-k feature)."""
    path = scratch_path(spark, "inference-subset")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    ranked = orders.withColumn("_minus", -F.col("price"))
    writers.write_inference_input(ranked, path, ["key", "price"], n=250, order_by=["_minus", "key"])
    return spark.read.schema("key bigint, price double").csv(path)


@query("preview", "SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 5")
def preview(spark, sf):
    """The first rows in key order (a top-k feature)."""
    return readers.preview(table(spark, sf, "events").select("event_id", "user_id", "event_type", "value").orderBy("event_id"))


@query("io_inference_input", f"""
WITH {FEATURED} SELECT "MONTH", "DISTANCE", "DEP_HOUR" FROM featured WHERE split = 'test'""")
def io_inference_input(spark, sf):
    path = scratch_path(spark, "inference")
    features = ["MONTH", "DISTANCE", "DEP_HOUR"]
    writers.write_inference_input(_basic(spark, sf).where("split = 'test'"), path, features)
    return readers.read_matrix_csv(spark, path, features, label=None)


@query("io_scored_csv", f"WITH {SCORED} SELECT probability, CAST(probability >= 0.5 AS INTEGER) AS prediction, label FROM scored")
def io_scored_csv(spark, sf):
    path = scratch_path(spark, "scored-csv")
    rows = scored(spark, sf).withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))
    writers.write_scored(rows, path)
    return spark.read.schema("probability double, prediction int, label int").option("header", True).csv(path)


@query("io_predictions", f"""
WITH {SCORED}, c AS (
  SELECT COUNT(*) AS total, COUNT(*) FILTER (probability < 0.5) AS on_time,
         COUNT(*) FILTER (probability >= 0.5) AS delayed FROM scored)
SELECT total, on_time, delayed, round(on_time * 100 / CAST(total AS DOUBLE), 6) AS on_time_pct,
  round(delayed * 100 / CAST(total AS DOUBLE), 6) AS delayed_pct FROM c""")
def io_predictions(spark, sf):
    path = scratch_path(spark, "predictions")
    scored(spark, sf).select("probability").write.csv(path)
    return rounded(prediction_summary(readers.read_predictions(spark, path)))


@query("io_report_json", f"""
WITH {SCORED}, {_evaluate_ctes('scored', 'segment')} SELECT segment, f1_score, auc, false_positive FROM evaluated""")
def io_report_json(spark, sf):
    path = scratch_path(spark, "reports")
    report = mt.evaluation_report(rounded(mt.evaluate(scored(spark, sf), by=["segment"])), ["segment"])
    writers.write_report(report, path)
    return spark.read.schema(report.schema).json(path).select(
        "segment", mt.metric("f1_score").alias("f1_score"), mt.metric("auc").alias("auc"),
        F.col("confusion_matrix.false_positive").alias("false_positive"),
    )


@query("io_rejections_json", f"""
WITH {_RUNS} SELECT version, run_day, '{gt.REJECTED}' AS status, CAST(0.20 AS DOUBLE) AS required, f1_score AS actual, auc,
  {len(gt.ADVICE_ALWAYS)} + CASE WHEN f1_score < 0.10 THEN {len(gt.ADVICE_POOR)} ELSE 0 END
    + CASE WHEN precision < 0.15 OR recall < 0.20 THEN {len(gt.ADVICE_FEATURES)} ELSE 0 END AS n_recommendations
FROM evaluated WHERE f1_score < 0.20""")
def io_rejections_json(spark, sf):
    """Nested rejection records, written as JSON and read back."""
    path = scratch_path(spark, "rejections")
    report = gt.rejection_report(rounded(_runs(spark, sf)), 0.20, ["version", "run_day"])
    writers.write_report(report, path)
    return spark.read.schema(report.schema).json(path).select(
        "version", "run_day", "status", "threshold.required", "threshold.actual", "model_metrics.auc",
        F.size("recommendations").alias("n_recommendations"),
    )


@query("io_manifest", f"""
WITH {LABELLED} SELECT split, COUNT(*) AS n, true AS whole, false AS written_again FROM labelled GROUP BY split""")
def io_manifest(spark, sf):
    """Splits as one all-or-nothing output; a second write skips it because its manifest says that it is whole."""
    path = scratch_path(spark, "published")
    rows = labelled(spark, sf)
    publish(rows, path, "csv", partition_by=("split",), header=True)
    again = publish(rows, path, "csv", "skip", ("split",), header=True)
    read = readers.read_splits(spark, assert_complete(spark, path))
    return read.groupBy("split").agg(F.count("*").alias("n")).select("split", "n", F.lit(finished(spark, path)).alias("whole"), F.lit(again).alias("written_again"))


# ---------------------------------------------------------------- ground truth and streams

# Labels are uploaded some time of the day after the event, at any minute and second; every 53rd comes three days later.
_UPLOADS = f"""{SCORED}, uploads AS (
  SELECT id, label, date_trunc('day', ts) + CASE WHEN seq % 53 = 0 THEN INTERVAL 4 DAY ELSE INTERVAL 1 DAY END
    + to_seconds((seq * 7919) % 86400) AS truth_ts
  FROM scored)"""


def _uploads(spark: SparkSession, sf: str) -> DataFrame:
    days = F.when(F.col("seq") % 53 == 0, 4).otherwise(1)
    offset = F.make_dt_interval(days=days, secs=F.pmod(F.col("seq") * 7919, F.lit(86400)).cast("decimal(18,6)"))
    return scored(spark, sf).withColumn("at", F.date_trunc("day", "ts").cast("timestamp_ntz") + offset).select("id", "label", "at")


def _write_uploads(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "ground-truth")
    writers.write_ground_truth_table(_uploads(spark, sf), path, "at")
    return path


@query("truth_paths", f"""
WITH {_UPLOADS} SELECT strftime(truth_ts, '%Y/%m/%d/%H/%M%S') || '.jsonl' AS path, COUNT(*) AS n, strftime(truth_ts, '%Y-%m-%d %H:%M:%S') AS read_back
FROM uploads GROUP BY ALL""")
def truth_paths(spark, sf):
    """The upload file that each label belongs in by its time, and the time that a reader takes from that path."""
    paths = _uploads(spark, sf).groupBy(truth_path("at").alias("path")).agg(F.count("*").alias("n"))
    return paths.withColumn("read_back", F.date_format(truth_time("path"), "yyyy-MM-dd HH:mm:ss"))


@query("io_ground_truth", f"""
WITH {_UPLOADS} SELECT id, label, strftime(truth_ts, '%Y-%m-%d %H:%M:%S') AS truth_ts FROM uploads""")
def io_ground_truth(spark, sf):
    truth = readers.read_ground_truth(spark, _write_uploads(spark, sf))
    return truth.withColumn("truth_ts", F.date_format("truth_ts", "yyyy-MM-dd HH:mm:ss"))


# All test times lie years before these; a row at such a time ends an input, so that the watermark passes everything before it. With two of them
# the rows of the first are matched and emitted themselves, and end whatever reads the output.
_ENDS = (datetime(2040, 1, 1, tzinfo=timezone.utc), datetime(2041, 1, 1, tzinfo=timezone.utc))


def _stream_to(spark: SparkSession, stream: DataFrame, name: str) -> str:
    """Folder of what a stream emits from all data present. Nothing is added to it: a stream that emits nothing gives no rows."""
    out, state = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-state")
    run_available(stream, out, state, state_partitions=spark.sparkContext.defaultParallelism)
    return out


def _emitted(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    return spark.read.schema(stream.schema).parquet(_stream_to(spark, stream, name))


def _scored_folder(spark: SparkSession, rows: DataFrame, name: str, ends: int = 1) -> str:
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    for at in _ENDS[:ends]:
        close_input(spark, path, rows.schema, at)
    return path


def _truth_folder(spark: SparkSession, rows: DataFrame, name: str, ends: int = 1) -> str:
    path = scratch_path(spark, name)
    writers.write_ground_truth_table(rows, path, "truth_ts", by_hour=False)
    for at in _ENDS[:ends]:
        close_truth(spark, path, at)
    return path


# Rows of a stream that are worth a batch of their own.
_SLICE_ROWS = 1_000_000


def _cuts(rows: DataFrame, ts: str, apart: int) -> list[int]:
    """Times (microseconds) that cut ``rows`` into slices of at least ``_SLICE_ROWS``, about, and ``apart`` seconds."""
    n = rows.count() // _SLICE_ROWS
    if n < 2:
        return []
    cuts: list[int] = []
    for t in rows.agg(F.percentile_approx(F.unix_micros(ts), [i / n for i in range(1, n)])).first()[0] or []:
        if not cuts or t - cuts[-1] >= apart * 1_000_000:
            cuts.append(t)
    return cuts


def _sliced(spark: SparkSession, rows: DataFrame, ts: str, cuts: list[int], name: str) -> list[DataFrame]:
    """``rows`` in slices, in the order of time. With cuts they are written once, by slice."""
    if not cuts:
        return [rows]
    path, time = scratch_path(spark, name), F.unix_micros(F.col(ts).cast("timestamp"))
    rows.withColumn("_slice", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.coalesce(time, F.lit(0))))).write.partitionBy("_slice").parquet(path)
    written = spark.read.schema(rows.select("*", F.lit(0).alias("_slice")).schema).parquet(path)
    return [written.where(F.col("_slice") == k).drop("_slice") for k in range(len(cuts) + 1)]


def _emitted_in_slices(
    spark: SparkSession, rows: DataFrame, labels: DataFrame, build: Callable[[str, str], DataFrame], name: str, delay: int,
) -> DataFrame:
    """What the stream ``build`` of a folder of scored rows and one of truth emits when both fill up over time, and it is run for each slice.

    No row of a slice is before one of a slice before, so none is late, and the state is that of one slice and the ``delay`` (seconds) before it, not of all
    rows. A slice takes at least twice the delay, as every batch walks through the state.
    """
    source, uploads = scratch_path(spark, f"{name}-scored"), scratch_path(spark, f"{name}-truth")
    out, state = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-state")
    cuts = _cuts(rows, "ts", 2 * delay)
    parts = [*zip(_sliced(spark, rows, "ts", cuts, f"{name}-rows"), _sliced(spark, labels, "truth_ts", cuts, f"{name}-labels"), strict=True)]
    for k, (some, truths) in enumerate(parts):
        some.write.mode("append").parquet(source)
        writers.write_ground_truth_table(truths, uploads, "truth_ts", by_hour=False)
        if k == len(parts) - 1:
            close_input(spark, source, rows.schema, _ENDS[0])
            close_truth(spark, uploads, _ENDS[0])
        stream = build(source, uploads)
        run_available(stream, out, state, state_partitions=spark.sparkContext.defaultParallelism)
    return spark.read.schema(stream.schema).parquet(out)


def _at(column: str = "ts"):
    return F.col(column).cast("timestamp").alias(column)


# A window is emitted once the watermark (an hour behind the slower stream) rules out any further match for it.
@query("stream_quality", f"""
WITH {_UPLOADS}, joined AS (
  SELECT date_trunc('day', s.ts) AS window_start, probability, u.label FROM scored AS s JOIN uploads AS u
    ON s.id = u.id AND u.truth_ts >= s.ts AND u.truth_ts <= s.ts + INTERVAL 2 DAY),
{_evaluate_ctes('joined', 'window_start')}
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, {_FOUR}, accuracy, precision, recall, f1_score, auc,
  CAST(0 AS DOUBLE) AS auc_error FROM evaluated""")
def stream_quality(spark, sf):
    """Scored rows and late labels as streams, joined and evaluated per day with AUC; windows as Parquet files."""
    rows = scored(spark, sf).select("id", _at(), "probability")
    labels = _uploads(spark, sf).withColumnRenamed("at", "truth_ts")

    def quality(source: str, uploads: str) -> DataFrame:
        return quality_stream(scored_stream(spark, source, fmt="parquet"), truth_stream(spark, uploads), "1 day", "2 days")

    return _printed(rounded(_emitted_in_slices(spark, rows, labels, quality, "quality", 2 * 86400)), "window_start")


@query("stream_summary_live", f"""
WITH {SCORED} SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, version, COUNT(*) AS n,
  round(AVG(CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END) * 100, 6) AS predicted_rate FROM scored GROUP BY 1, 2""")
def stream_summary_live(spark, sf):
    """Rows and predicted rate per day and version as a stream."""
    rows = scored(spark, sf).select("id", _at(), "probability", "version")
    source = _scored_folder(spark, rows, "summary-scored")
    summary = mo.stream_summary(scored_stream(spark, source, rows.schema, "parquet"), label=None, by=["version"])
    return _printed(rounded(_emitted(spark, summary, "summary")), "window_start")


# Five hundred ids used again and again by both versions; the truth of a run comes within two hours, late, or never.
_REUSED = f"""{TRUTH}, s AS (SELECT CAST(seq % 500 AS VARCHAR) AS id, ts, version, min(probability) AS probability FROM scored GROUP BY ALL),
t AS (SELECT DISTINCT CAST(CAST(id AS BIGINT) % 500 AS VARCHAR) AS id, label, truth_ts FROM truth),
m AS (SELECT s.*, t.label, t.truth_ts FROM t JOIN s ON s.id = t.id AND t.truth_ts >= s.ts AND t.truth_ts <= s.ts + INTERVAL 2 DAY
  QUALIFY row_number() OVER (PARTITION BY t.id, t.label, t.truth_ts ORDER BY s.ts DESC, s.version DESC, s.probability DESC) = 1)"""


def _reused(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = scored(spark, sf).groupBy(F.pmod("seq", F.lit(500)).cast("string").alias("id"), _at(), "version").agg(F.min("probability").alias("probability"))
    labels = truth(spark, sf).select(F.pmod(F.col("id").cast("bigint"), F.lit(500)).cast("string").alias("id"), "label", "truth_ts")
    return rows, labels


def _matches(spark: SparkSession, sf: str) -> tuple[str, DataFrame, str]:
    """Folder and frame of the scored rows, and the folder to which a stream has written their matches."""
    rows, labels = _reused(spark, sf)
    source, uploads = _scored_folder(spark, rows, "reused-scored", 2), _truth_folder(spark, labels, "reused-truth", 2)
    stream = match_stream(scored_stream(spark, source, rows.schema, "parquet"), truth_stream(spark, uploads), "2 days")
    return source, rows, _stream_to(spark, stream, "matches")


_MATCH_SCHEMA = schema_of({"id": "string", "ts": "timestamp", "version": "int", "probability": "double", "truth_ts": "timestamp", "label": "int"})


@query("stream_latest_match", f"""
WITH {_REUSED} SELECT id, version, label, probability, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, strftime(truth_ts, '%Y-%m-%d %H:%M:%S') AS truth_ts FROM m""")
def stream_latest_match(spark, sf):
    """Each truth row of a stream with the latest scored row before it, although ids restart."""
    matches = spark.read.schema(_MATCH_SCHEMA).parquet(_matches(spark, sf)[2])
    return _printed(matches.where("id <> ''"), "ts", "truth_ts")


@query("stream_latest_quality", f"""
WITH {_REUSED}, days AS (SELECT date_trunc('day', ts) AS window_start, version, probability, label FROM m),
{_evaluate_ctes('days', 'window_start, version')}
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, version, {_FOUR}, accuracy, precision, recall, f1_score, auc FROM evaluated""")
def stream_latest_quality(spark, sf):
    """The written matches as a stream of their own, evaluated per day and version."""
    quality = window_quality_stream(matches_stream(spark, _matches(spark, sf)[2], _MATCH_SCHEMA, "2 days"), "1 day", by=["version"])
    return _printed(rounded(_emitted(spark, quality, "latest-quality")), "window_start").drop("auc_error")


@query("stream_coverage", f"""
WITH {_REUSED}, first AS (SELECT id, ts, version, probability, min(truth_ts) AS truth_ts FROM m GROUP BY ALL)
SELECT strftime(date_trunc('day', s.ts), '%Y-%m-%d %H:%M:%S') AS window_start, s.version, COUNT(*) AS n_scored,
  COUNT(*) FILTER (truth_ts <= s.ts + INTERVAL 1 HOUR) AS n_matched, COUNT(*) FILTER (truth_ts > s.ts + INTERVAL 1 HOUR) AS n_late,
  COUNT(*) FILTER (truth_ts IS NULL) AS n_unmatched
FROM s LEFT JOIN first AS f ON s.id = f.id AND s.ts = f.ts AND s.version = f.version AND s.probability = f.probability GROUP BY ALL""")
def stream_coverage(spark, sf):
    """Scored rows per day and version: with truth within an hour, with truth within two days, and without."""
    source, rows, matches = _matches(spark, sf)
    covered = coverage_stream(
        scored_stream(spark, source, rows.schema, "parquet"), matches_stream(spark, matches, _MATCH_SCHEMA, "2 days"), "1 day", "1 hour", ["version"])
    return _printed(_emitted(spark, covered, "coverage"), "window_start")


# The metrics of ten-minute windows end three hours after the last of all groups: up to there every period of a group has a state.
_ALARMS = f"""{SCORED}, slots AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start, segment, probability, label FROM scored),
{_evaluate_ctes('slots', 'window_start, segment')},
avgs AS (SELECT segment, time_bucket(INTERVAL 30 MINUTE, window_start) AS period_start, AVG(f1_score) AS average FROM evaluated GROUP BY ALL),
ends AS (SELECT time_bucket(INTERVAL 30 MINUTE, max(window_start) + INTERVAL 3 HOUR) AS ended FROM evaluated),
spine AS (SELECT segment, unnest(generate_series(min(period_start), any_value(ended) - INTERVAL 30 MINUTE, INTERVAL 30 MINUTE)) AS period_start
  FROM avgs, ends GROUP BY segment)"""


@query("stream_alarm", f"""
WITH {_ALARMS} SELECT segment, strftime(period_start, '%Y-%m-%d %H:%M:%S') AS period_start, round(average, 6) AS average, coalesce(average <= 0.4, true) AS in_alarm
FROM spine LEFT JOIN avgs USING (segment, period_start)""")
def stream_alarm(spark, sf):
    """Half-hour alarm states per segment from a stream of ten-minute metrics; a period without data alarms when it has passed."""
    slots = rounded(mo.evaluate_windows(scored(spark, sf), "10 minutes", ["segment"])).select("window_start", "segment", "f1_score")
    slots = pin(slots.withColumn("window_start", F.col("window_start").cast("timestamp")))
    path = scratch_path(spark, "alarm-metrics")
    slots.write.parquet(path)
    end = slots.agg(F.unix_micros(F.max("window_start"))).first()[0]
    if end is not None:  # a metric of a group '' ends the stream at this time
        close_input(spark, path, slots.schema, datetime.fromtimestamp(end / 1e6 + 3 * 3600, timezone.utc), "window_start")
    metrics = spark.readStream.schema(slots.schema).parquet(path).withWatermark("window_start", "0 seconds")
    states = alarm_stream(metrics, 1800, 0.4, by=["segment"])
    return _printed(rounded(_emitted(spark, states, "alarm")), "period_start")
