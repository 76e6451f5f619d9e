"""Registered queries over flights: cleaning, exploration, splits, features, encodings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch.functions import dep_hour, flight_id, event_time, safe_ratio
from latewatch.operators import clean as cl
from latewatch.operators import profile as pf
from latewatch.operators import splits as sp
from latewatch.operators.encoders import (
    COUNT_FEATURES, HOUR_RATE_FEATURES, RATE_FEATURES, KeyStatistics, MedianImputer, StatisticsHistory, TargetEncoding,
    VolumeEncoding,
)
from latewatch.operators.lookups import missing, with_names
from latewatch.operators.matrix import (
    add_distance_features, add_route, add_temporal_features, non_numeric_columns, select_matrix, split_xy,
)
from latewatch.plans.registry import query, rounded
from latewatch.plans.tables import CLEANED, FEATURED, FLIGHTS, LABELLED, cleaned, flights, labelled, table
from latewatch.runtime import scratch_path
from latewatch.schemas import FEATURE_SETS
from latewatch.sources.catalog import table_counts as count_tables

# ---------------------------------------------------------------- cleaning


@query("clean_flights", f"""
WITH {CLEANED} SELECT * FROM cleaned""")
def clean_flights(spark, sf):
    return cleaned(spark, sf)


@query("labelled", f"""
WITH {LABELLED} SELECT * FROM labelled""")
def labelled_flights(spark, sf):
    return labelled(spark, sf)


@query("clean_funnel", f"""
WITH {FLIGHTS}, c AS (
  SELECT COUNT(*) AS n0, COUNT(*) FILTER ("CANCELLED" = 0 AND "DIVERTED" = 0) AS n1,
    COUNT(*) FILTER ("CANCELLED" = 0 AND "DIVERTED" = 0 AND "ARRIVAL_DELAY" IS NOT NULL) AS n2,
    COUNT(*) FILTER ("CANCELLED" = 0 AND "DIVERTED" = 0 AND "ARRIVAL_DELAY" IS NOT NULL
                     AND "SCHEDULED_TIME" IS NOT NULL AND "DISTANCE" IS NOT NULL) AS n3
  FROM flights)
SELECT CAST(0 AS INTEGER) AS step_no, 'raw' AS step, n0 AS remaining, CAST(0 AS BIGINT) AS removed FROM c
UNION ALL SELECT 1, 'operated', n1, n0 - n1 FROM c
UNION ALL SELECT 2, 'has_arrival_delay', n2, n1 - n2 FROM c
UNION ALL SELECT 3, 'has_inputs', n3, n2 - n3 FROM c""")
def clean_funnel(spark, sf):
    return cl.clean_funnel(flights(spark, sf))


@query("clean_funnel_random", f"""
WITH {FLIGHTS}, c AS (
  SELECT COUNT(*) AS n0, COUNT(*) FILTER ("CANCELLED" = 0 AND "DIVERTED" = 0) AS n1,
    COUNT(*) FILTER ("CANCELLED" = 0 AND "DIVERTED" = 0 AND "ARRIVAL_DELAY" IS NOT NULL) AS n2,
    COUNT(*) FILTER ("CANCELLED" = 0 AND "DIVERTED" = 0 AND "ARRIVAL_DELAY" IS NOT NULL
                     AND "SCHEDULED_TIME" IS NOT NULL) AS n3
  FROM flights)
SELECT CAST(0 AS INTEGER) AS step_no, 'raw' AS step, n0 AS remaining, CAST(0 AS BIGINT) AS removed FROM c
UNION ALL SELECT 1, 'operated', n1, n0 - n1 FROM c
UNION ALL SELECT 2, 'has_arrival_delay', n2, n1 - n2 FROM c
UNION ALL SELECT 3, 'has_inputs', n3, n2 - n3 FROM c""")
def clean_funnel_random(spark, sf):
    return cl.clean_funnel(flights(spark, sf), required=cl.REQUIRED_RANDOM)


# ---------------------------------------------------------------- exploration


@query("target_summary", f"""
WITH {FLIGHTS}, c AS (
  SELECT COUNT(*) AS total, COUNT(*) FILTER ("ARRIVAL_DELAY" > 15) AS delayed,
    COUNT(*) FILTER ("ARRIVAL_DELAY" <= 15) AS on_time, COUNT(*) FILTER ("ARRIVAL_DELAY" IS NULL) AS missing
  FROM flights)
SELECT total, delayed, on_time, missing,
  round(delayed * 100 / CAST(total AS DOUBLE), 6) AS delayed_pct,
  round(on_time * 100 / CAST(total AS DOUBLE), 6) AS on_time_pct,
  round(missing * 100 / CAST(total AS DOUBLE), 6) AS missing_pct,
  round(on_time / CAST(delayed AS DOUBLE), 6) AS imbalance
FROM c""")
def target_summary(spark, sf):
    return rounded(pf.target_summary(flights(spark, sf)))


def _missing_sql(columns: list[str]) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (\"{c}\" IS NULL) AS n_missing, "
        f"round(COUNT(*) FILTER (\"{c}\" IS NULL) * 100 / CAST(COUNT(*) AS DOUBLE), 2) AS pct_missing FROM operated"
        for c in columns
    ]
    return (
        f'WITH {FLIGHTS}, operated AS (SELECT * FROM flights WHERE "CANCELLED" = 0 AND "DIVERTED" = 0)\n'
        + "\nUNION ALL ".join(parts)
    )


_PROFILED = [*cl.MODEL_COLUMNS, "ARRIVAL_DELAY"]


@query("missing_profile", _missing_sql(_PROFILED))
def missing_profile(spark, sf):
    operated = flights(spark, sf).where("CANCELLED = 0 AND DIVERTED = 0")
    return pf.missing_profile(operated, _PROFILED)


_SEVERITY = "CASE WHEN rate > 20 THEN 'high' WHEN rate > 15 THEN 'medium' ELSE 'low' END"


@query("rate_by_airline", f"""
WITH {FLIGHTS}, r AS (
  SELECT "AIRLINE", COUNT(*) AS n,
         AVG(CASE WHEN coalesce("ARRIVAL_DELAY" > 15, false) THEN 1 ELSE 0 END) * 100 AS rate
  FROM flights WHERE "AIRLINE" IS NOT NULL GROUP BY "AIRLINE")
SELECT "AIRLINE", n, round(rate, 6) AS rate, {_SEVERITY} AS severity FROM r""")
def rate_by_airline(spark, sf):
    return rounded(pf.rate_by(flights(spark, sf), "AIRLINE"))


def _rates_sql() -> str:
    avg = 'AVG(CASE WHEN coalesce("ARRIVAL_DELAY" > 15, false) THEN 1 ELSE 0 END) * 100'
    parts = [
        f"SELECT '{c}' AS dimension, CAST(\"{c}\" AS VARCHAR) AS value, COUNT(*) AS n, {avg} AS rate "
        f'FROM h WHERE "{c}" IS NOT NULL GROUP BY "{c}"'
        for c in ("DEP_HOUR", "DAY_OF_WEEK", "MONTH")
    ] + [f"SELECT 'overall', NULL, COUNT(*), {avg} FROM h"]
    return (
        f'WITH {FLIGHTS}, h AS (SELECT *, CAST("SCHEDULED_DEPARTURE" // 100 AS INTEGER) AS "DEP_HOUR" FROM flights),\n'
        f"r AS ({' UNION ALL '.join(parts)})\n"
        f"SELECT dimension, value, n, round(rate, 6) AS rate, {_SEVERITY} AS severity FROM r"
    )


@query("rate_by_time", _rates_sql())
def rate_by_time(spark, sf):
    df = flights(spark, sf).withColumn("DEP_HOUR", dep_hour("SCHEDULED_DEPARTURE"))
    return rounded(pf.rates_by_each(df, ["DEP_HOUR", "DAY_OF_WEEK", "MONTH"]))


@query("value_counts_hour", f"""
WITH {FLIGHTS} SELECT CAST("SCHEDULED_DEPARTURE" // 100 AS INTEGER) AS value, COUNT(*) AS n
FROM flights GROUP BY 1""")
def value_counts_hour(spark, sf):
    return pf.value_counts(flights(spark, sf), dep_hour("SCHEDULED_DEPARTURE"))


@query("value_counts_month", f"""
WITH {FLIGHTS} SELECT "MONTH" AS value, COUNT(*) AS n FROM flights GROUP BY 1""")
def value_counts_month(spark, sf):
    return pf.value_counts(flights(spark, sf), "MONTH")


@query("top_airlines", f"""
WITH {FLIGHTS} SELECT "AIRLINE" AS value, COUNT(*) AS n FROM flights GROUP BY 1
ORDER BY n DESC, value LIMIT 10""")
def top_airlines(spark, sf):
    return pf.top_k(flights(spark, sf), "AIRLINE", 10)


@query("airline_names", """
WITH codes AS (SELECT CASE WHEN c_custkey % 11 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS c_nationkey FROM customer)
SELECT c_nationkey, COUNT(*) AS n, substr(coalesce(any_value(n_name), CAST(c_nationkey AS VARCHAR)), 1, 25) AS name
FROM codes LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY c_nationkey""")
def airline_names(spark, sf):
    """Codes to names with the whole lookup; some codes are not in it, so that the fallback is used."""
    code = F.when(F.col("c_custkey") % 11 == 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey"))
    counts = table(spark, sf, "customer").groupBy(code.alias("c_nationkey")).agg(F.count("*").alias("n"))
    return with_names(counts, table(spark, sf, "nation"), "c_nationkey", code="n_nationkey", name="n_name")


def _histogram_sql(column: str, bins: int) -> str:
    return f"""
WITH {FLIGHTS}, m AS (
  SELECT min("{column}") AS lo, max("{column}") AS hi, (max("{column}") - min("{column}")) / {bins} AS w FROM flights),
c AS (
  SELECT CAST(least(floor(("{column}" - lo) / w), {bins - 1}) AS INTEGER) AS bin, COUNT(*) AS n
  FROM flights, m WHERE "{column}" IS NOT NULL GROUP BY 1)
SELECT CAST(g.i AS INTEGER) AS bin, round(lo + g.i * w, 6) AS lower, round(lo + (g.i + 1) * w, 6) AS upper,
       coalesce(n, 0) AS n
FROM m, (SELECT unnest(generate_series(0, {bins - 1})) AS i) AS g LEFT JOIN c ON c.bin = g.i"""


@query("histogram_delay", _histogram_sql("ARRIVAL_DELAY", 100))
def histogram_delay(spark, sf):
    return rounded(pf.histogram(flights(spark, sf), "ARRIVAL_DELAY", 100))


@query("histogram_distance", _histogram_sql("DISTANCE", 50))
def histogram_distance(spark, sf):
    return rounded(pf.histogram(flights(spark, sf), "DISTANCE", 50))


@query("median_distance", f"""
WITH {FLIGHTS} SELECT quantile_cont("DISTANCE", 0.5) AS "DISTANCE_median" FROM flights""")
def median_distance(spark, sf):
    return pf.median(flights(spark, sf), "DISTANCE")


@query("median_price_by_flag", """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 6) AS l_extendedprice_median
FROM lineitem GROUP BY l_returnflag""")
def median_price_by_flag(spark, sf):
    """A median over many distinct values, per group."""
    return rounded(pf.median(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"]))


@query("distinct_counts", f"""
WITH {FLIGHTS} SELECT COUNT(DISTINCT "AIRLINE") AS "AIRLINE_distinct",
  COUNT(DISTINCT "ORIGIN_AIRPORT") AS "ORIGIN_AIRPORT_distinct",
  COUNT(DISTINCT "DESTINATION_AIRPORT") AS "DESTINATION_AIRPORT_distinct" FROM flights""")
def distinct_counts(spark, sf):
    return pf.n_distinct(flights(spark, sf), cl.CATEGORICAL)


@query("distinct_months", f"""
WITH {FLIGHTS} SELECT DISTINCT "MONTH" FROM flights WHERE "MONTH" IS NOT NULL""")
def distinct_months(spark, sf):
    return pf.distinct_values(flights(spark, sf), "MONTH")


@query("non_numeric_columns", f"""
WITH {LABELLED}, v AS (
  SELECT DISTINCT 'AIRLINE' AS "column", "AIRLINE" AS value FROM labelled
  UNION ALL SELECT DISTINCT 'ORIGIN_AIRPORT', "ORIGIN_AIRPORT" FROM labelled
  UNION ALL SELECT DISTINCT 'DESTINATION_AIRPORT', "DESTINATION_AIRPORT" FROM labelled
  UNION ALL SELECT DISTINCT 'split', split FROM labelled)
SELECT "column", 'string' AS type, value FROM v
QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY value) <= 5""")
def non_numeric(spark, sf):
    return non_numeric_columns(labelled(spark, sf))


@query("missing_keys", """
SELECT DISTINCT o_orderkey AS key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def missing_keys(spark, sf):
    """Expected keys (orders) that were not found (no line item)."""
    expected = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"))
    found = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"))
    return missing(expected, found, "key")


_COUNTED = ["lineitem", "orders", "customer", "supplier", "part", "nation", "region", "events"]


@query("table_counts", "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n FROM {t}" for t in _COUNTED))
def table_counts(spark, sf):
    for name in _COUNTED:
        table(spark, sf, name).createOrReplaceTempView(f"lw_{name}")
    counts = count_tables(spark, [f"lw_{n}" for n in _COUNTED])
    return counts.withColumn("table_name", F.expr("substring(table_name, 4)"))


# ---------------------------------------------------------------- splits


@query("temporal_split", f"""
WITH {LABELLED} SELECT split, "MONTH", COUNT(*) AS n FROM labelled GROUP BY ALL""")
def temporal_split(spark, sf):
    return labelled(spark, sf).groupBy("split", "MONTH").agg(F.count("*").alias("n"))


@query("split_summary", f"""
WITH {LABELLED} SELECT split, COUNT(*) AS n, COUNT(*) FILTER ("DELAYED" = 1) AS n_delayed,
  round(AVG("DELAYED") * 100, 6) AS delay_rate,
  round(COUNT(*) * 100 / CAST((SELECT COUNT(*) FROM labelled) AS DOUBLE), 6) AS pct
FROM labelled GROUP BY split""")
def split_summary(spark, sf):
    return rounded(pf.split_summary(labelled(spark, sf)))


@query("split_detail", f"""
WITH {LABELLED} SELECT split, COUNT(*) AS n, COUNT(DISTINCT "AIRLINE") AS "AIRLINE_distinct",
  COUNT(DISTINCT "ORIGIN_AIRPORT") AS "ORIGIN_AIRPORT_distinct",
  COUNT(DISTINCT "DESTINATION_AIRPORT") AS "DESTINATION_AIRPORT_distinct",
  round(AVG("DISTANCE"), 6) AS "DISTANCE_mean", round(AVG("SCHEDULED_TIME"), 6) AS "SCHEDULED_TIME_mean"
FROM labelled GROUP BY split""")
def split_detail(spark, sf):
    return rounded(pf.split_detail(labelled(spark, sf)))


@query("verify_splits", f"""
WITH {FLIGHTS}, s AS (
  SELECT "MONTH", "SCHEDULED_TIME", "DISTANCE", "ARRIVAL_DELAY", CAST("ARRIVAL_DELAY" > 15 AS INTEGER) AS "DELAYED",
    CASE WHEN "MONTH" <= 9 THEN 'train' WHEN "MONTH" = 10 THEN 'val'
         WHEN "MONTH" = 11 THEN 'test' ELSE 'prod' END AS split FROM flights),
v AS (
  SELECT split, COUNT(*) AS n, COUNT(*) FILTER ("DELAYED" = 1) AS n_delayed,
    COUNT(*) FILTER ("DELAYED" = 0) AS n_on_time, round(AVG("DELAYED") * 100, 6) AS delay_rate,
    COUNT(*) FILTER ("MONTH" IS NULL) + COUNT(*) FILTER ("SCHEDULED_TIME" IS NULL)
      + COUNT(*) FILTER ("DISTANCE" IS NULL) + COUNT(*) FILTER ("ARRIVAL_DELAY" IS NULL)
      + COUNT(*) FILTER ("DELAYED" IS NULL) AS n_missing
  FROM s GROUP BY split)
SELECT *, CAST(5 AS INTEGER) AS n_columns, CASE WHEN n_missing = 0 THEN 'OK' ELSE 'WARNING' END AS status FROM v""")
def verify_splits(spark, sf):
    raw = flights(spark, sf).select("MONTH", "SCHEDULED_TIME", "DISTANCE", "ARRIVAL_DELAY")
    return rounded(pf.verify_splits(sp.temporal_split(cl.with_label(raw, drop_source=False))))


@query("verify_split_frames", f"""
WITH {LABELLED}, v AS (
  SELECT split, COUNT(*) AS n, COUNT(*) FILTER ("DELAYED" = 1) AS n_delayed, COUNT(*) FILTER ("DELAYED" = 0) AS n_on_time,
    round(AVG("DELAYED") * 100, 6) AS delay_rate,
    COUNT(*) FILTER ("MONTH" IS NULL) + COUNT(*) FILTER ("DISTANCE" IS NULL) + COUNT(*) FILTER ("DELAYED" IS NULL) AS n_missing
  FROM labelled GROUP BY split)
SELECT *, CAST(3 AS INTEGER) AS n_columns, CASE WHEN n_missing = 0 THEN 'OK' ELSE 'WARNING' END AS status, split <> 'test' AS schema_matches FROM v""")
def verify_split_frames(spark, sf):
    """Splits stored apart; one of them has its columns in another order."""
    columns = ["MONTH", "DISTANCE", "DELAYED"]
    frames = {
        name: labelled(spark, sf).where(F.col("split") == name).select(*(columns[::-1] if name == "test" else columns))
        for name in ("train", "val", "test", "prod")
    }
    return rounded(pf.verify_split_frames(frames))


_ORDERS = """
o AS (
  SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS label,
         md5('42|' || CAST(o_orderkey AS VARCHAR)) AS digest
  FROM orders)"""


def _order_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"))


@query("stratified_split", f"""
WITH {_ORDERS}, r AS (
  SELECT o_orderkey, label, row_number() OVER (PARTITION BY label ORDER BY digest) AS k,
         COUNT(*) OVER (PARTITION BY label) AS n FROM o)
SELECT o_orderkey, label,
  CASE WHEN k <= round(n * CAST(0.4 AS DOUBLE)) THEN 'train' WHEN k <= round(n * CAST(0.5 AS DOUBLE)) THEN 'val'
       WHEN k <= round(n * CAST(0.6 AS DOUBLE)) THEN 'test' ELSE 'prod' END AS split
FROM r""")
def stratified_split(spark, sf):
    return sp.stratified_split(_order_labels(spark, sf), "label", "o_orderkey")


@query("stratified_split_hash", f"""
WITH {_ORDERS}
SELECT o_orderkey, label,
  CASE WHEN digest < '66666666666666666666666666666666' THEN 'train' WHEN digest < '80000000000000000000000000000000' THEN 'val'
       WHEN digest < '99999999999999999999999999999999' THEN 'test' ELSE 'prod' END AS split
FROM o""")
def stratified_split_hash(spark, sf):
    return sp.stratified_split(_order_labels(spark, sf), "label", "o_orderkey", exact=False)


@query("first_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500")
def first_n(spark, sf):
    return sp.first_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 500, "o_orderkey")


@query("capture_sample", """
SELECT event_id, event_type FROM events WHERE md5('0|' || CAST(event_id AS VARCHAR)) < '40000000000000000000000000000000'""")
def capture_sample(spark, sf):
    return sp.capture_sample(table(spark, sf, "events").select("event_id", "event_type"), 25, "event_id")


@query("class_weight", f"""
WITH {LABELLED}, c AS (
  SELECT COUNT(*) FILTER ("DELAYED" = 0) AS negatives, COUNT(*) FILTER ("DELAYED" = 1) AS positives
  FROM labelled WHERE split = 'train')
SELECT negatives, positives, round(least(negatives / CAST(positives AS DOUBLE), 3.0), 6) AS pos_weight FROM c""")
def class_weight(spark, sf):
    return rounded(pf.pos_weight(labelled(spark, sf).where("split = 'train'"), cap=3.0))


# ---------------------------------------------------------------- features


def featured(spark: SparkSession, sf: str) -> DataFrame:
    return add_route(add_distance_features(add_temporal_features(labelled(spark, sf), late_night=True)))


@query("row_features", f"""
WITH {FEATURED} SELECT split, "MONTH", "DAY", "DAY_OF_WEEK", "SCHEDULED_DEPARTURE", "DISTANCE", "DEP_HOUR", "ROUTE",
  round("HOUR_SIN", 9) AS "HOUR_SIN", round("HOUR_COS", 9) AS "HOUR_COS", "IS_PEAK_HOUR", "IS_WEEKEND",
  "IS_LATE_NIGHT", "IS_LONG_HAUL", "DISTANCE_BUCKET"
FROM featured""")
def row_features(spark, sf):
    return rounded(featured(spark, sf).select(
        "split", "MONTH", "DAY", "DAY_OF_WEEK", "SCHEDULED_DEPARTURE", "DISTANCE", "DEP_HOUR", "ROUTE", "HOUR_SIN",
        "HOUR_COS", "IS_PEAK_HOUR", "IS_WEEKEND", "IS_LATE_NIGHT", "IS_LONG_HAUL", "DISTANCE_BUCKET",
    ), 9)


@query("store_rows", f"""
WITH {CLEANED} SELECT "FLIGHT_KEY",
  CAST("YEAR" AS VARCHAR) || '-' || lpad(CAST("MONTH" AS VARCHAR), 2, '0') || '-' || lpad(CAST("DAY" AS VARCHAR), 2, '0')
    || '-' || "AIRLINE" || '-' || "ORIGIN_AIRPORT" || '-' || "DESTINATION_AIRPORT" || '-'
    || lpad(CAST("SCHEDULED_DEPARTURE" AS VARCHAR), 4, '0') AS flight_id,
  CAST(epoch(make_timestamp("YEAR", "MONTH", "DAY", 0, 0, 0.0)) AS DOUBLE) AS event_time
FROM cleaned""")
def store_rows(spark, sf):
    year = F.col("YEAR")
    return cleaned(spark, sf).select(
        "FLIGHT_KEY",
        flight_id(
            year, "MONTH", "DAY", "AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "SCHEDULED_DEPARTURE"
        ).alias("flight_id"),
        event_time(year, "MONTH", "DAY").alias("event_time"),
    )


def _speed(spark: SparkSession, sf: str) -> DataFrame:
    """Speed with gaps: a scheduled time that is a multiple of 90 counts as unknown here."""
    time = F.when(F.col("SCHEDULED_TIME") % 90 != 0, F.col("SCHEDULED_TIME")).otherwise(F.lit(0.0))
    return labelled(spark, sf).select("split", "MONTH", "DAY", "DISTANCE", safe_ratio("DISTANCE", time).alias("SPEED"))


_SPEED = f"""
WITH {LABELLED}, s AS (
  SELECT split, "MONTH", "DAY", "DISTANCE",
         CASE WHEN "SCHEDULED_TIME" % 90 <> 0 THEN "DISTANCE" / "SCHEDULED_TIME" END AS "SPEED" FROM labelled)"""


@query("speed_feature", _SPEED + """
SELECT split, "MONTH", "DAY", "DISTANCE",
  round(coalesce("SPEED", (SELECT quantile_cont("SPEED", 0.5) FROM s WHERE split = 'train')), 6) AS "SPEED"
FROM s""")
def speed_feature(spark, sf):
    df = _speed(spark, sf)
    return rounded(MedianImputer.fit(df.where("split = 'train'"), "SPEED").transform(df))


@query("speed_feature_per_split", _SPEED + """, m AS (
  SELECT split, quantile_cont("SPEED", 0.5) AS med FROM s GROUP BY split)
SELECT s.split, "MONTH", "DAY", "DISTANCE", round(coalesce("SPEED", med), 6) AS "SPEED"
FROM s JOIN m ON s.split = m.split""")
def speed_feature_per_split(spark, sf):
    df = _speed(spark, sf)
    return rounded(MedianImputer.fit(df, "SPEED", by="split").transform(df))


# ---------------------------------------------------------------- encodings


def _stats_sql(*keys: str) -> str:
    parts = [
        f'st_{k} AS (SELECT "{k}" AS k, SUM("DELAYED") AS s, COUNT(*) AS n FROM featured '
        f"WHERE split = 'train' AND \"{k}\" IS NOT NULL GROUP BY 1)"
        for k in keys
    ]
    return (
        f"WITH {FEATURED}, g AS (SELECT AVG(\"DELAYED\") AS rate FROM featured WHERE split = 'train'),\n"
        + ",\n".join(parts)
    )


def _joins_sql(*keys: str) -> str:
    return "FROM featured CROSS JOIN g " + " ".join(f'LEFT JOIN st_{k} ON "{k}" = st_{k}.k' for k in keys)


def _rate_sql(key: str, smoothing: int = 0) -> str:
    return f"coalesce((st_{key}.s + {smoothing} * g.rate) / (st_{key}.n + {smoothing}), g.rate)"


_KEYS = ("AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "ROUTE")


@query("flagship", _stats_sql("ROUTE") + f"""
SELECT split, COUNT(*) AS n, round(AVG("DELAYED") * 100, 6) AS delay_rate,
  round(AVG({_rate_sql("ROUTE")}), 6) AS mean_route_rate, COUNT(*) FILTER (st_ROUTE.k IS NULL) AS n_fallback
{_joins_sql("ROUTE")} GROUP BY split""")
def flagship(spark, sf):
    """Clean, label, split, learn route rates on the training split, apply them everywhere, summarise."""
    df = add_route(labelled(spark, sf))
    encoder = TargetEncoding.fit(df.where("split = 'train'"), {"ROUTE_DELAY_RATE": "ROUTE"})
    return rounded(encoder.transform(df, seen=True).groupBy("split").agg(
        F.count("*").alias("n"),
        (F.avg("DELAYED") * 100).alias("delay_rate"),
        F.avg("ROUTE_DELAY_RATE").alias("mean_route_rate"),
        F.count_if(~F.col("ROUTE_DELAY_RATE_SEEN")).alias("n_fallback"),
    ))


@query("target_encode", _stats_sql(*_KEYS) + f"""
SELECT split, "AIRLINE", "ROUTE", "DELAYED",
  round({_rate_sql("AIRLINE")}, 6) AS "AIRLINE_DELAY_RATE",
  round({_rate_sql("ORIGIN_AIRPORT")}, 6) AS "ORIGIN_DELAY_RATE",
  round({_rate_sql("DESTINATION_AIRPORT")}, 6) AS "DEST_DELAY_RATE",
  round({_rate_sql("ROUTE")}, 6) AS "ROUTE_DELAY_RATE"
{_joins_sql(*_KEYS)}""")
def target_encode(spark, sf):
    df = add_route(labelled(spark, sf)).select("split", *_KEYS, "DELAYED")
    encoder = TargetEncoding.fit(df.where("split = 'train'"))
    return rounded(encoder.transform(df).drop("ORIGIN_AIRPORT", "DESTINATION_AIRPORT"))


@query("target_encode_smoothed", _stats_sql(*_KEYS, "DEP_HOUR") + f"""
SELECT split, "AIRLINE", "ROUTE", "DEP_HOUR", "DELAYED",
  round({_rate_sql("AIRLINE", 100)}, 6) AS "AIRLINE_DELAY_RATE",
  round({_rate_sql("ORIGIN_AIRPORT", 100)}, 6) AS "ORIGIN_DELAY_RATE",
  round({_rate_sql("DESTINATION_AIRPORT", 100)}, 6) AS "DEST_DELAY_RATE",
  round({_rate_sql("ROUTE", 100)}, 6) AS "ROUTE_DELAY_RATE",
  round({_rate_sql("DEP_HOUR", 100)}, 6) AS "HOUR_DELAY_RATE"
{_joins_sql(*_KEYS, "DEP_HOUR")}""")
def target_encode_smoothed(spark, sf):
    df = add_temporal_features(add_route(labelled(spark, sf))).select("split", *_KEYS, "DEP_HOUR", "DELAYED")
    encoder = TargetEncoding.fit(
        df.where("split = 'train'"), {**RATE_FEATURES, **HOUR_RATE_FEATURES}, smoothing=100
    )
    return rounded(encoder.transform(df).drop("ORIGIN_AIRPORT", "DESTINATION_AIRPORT"))


_VOLUMES = ("ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "ROUTE")


def _volume_sql(key: str) -> str:
    return f"ln(1 + coalesce(st_{key}.n, 0))"


@query("volume_encode", _stats_sql(*_VOLUMES) + f"""
SELECT split, "ROUTE", round({_volume_sql("ORIGIN_AIRPORT")}, 6) AS "ORIGIN_FLIGHTS",
  round({_volume_sql("DESTINATION_AIRPORT")}, 6) AS "DEST_FLIGHTS", round({_volume_sql("ROUTE")}, 6) AS "ROUTE_FLIGHTS"
{_joins_sql(*_VOLUMES)}""")
def volume_encode(spark, sf):
    df = add_route(labelled(spark, sf)).select("split", *_VOLUMES, "DELAYED")
    encoder = VolumeEncoding.fit(df.where("split = 'train'"))
    return rounded(encoder.transform(df).drop("ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "DELAYED"))


def matrix_frame(spark: SparkSession, sf: str, features: str) -> DataFrame:
    """Everything a named feature set needs, with only the lookups it uses."""
    df = featured(spark, sf)
    names = FEATURE_SETS[features]
    if "SPEED" in names:  # fitted before the lookups, which its passes would otherwise repeat
        df = df.withColumn("SPEED", safe_ratio("DISTANCE", "SCHEDULED_TIME"))
        df = MedianImputer.fit(df.where("split = 'train'"), "SPEED").transform(df)
    rates = {f: k for f, k in {**RATE_FEATURES, **HOUR_RATE_FEATURES}.items() if f in names}
    counts = {f: k for f, k in COUNT_FEATURES.items() if f in names}
    if rates or counts:
        stats = KeyStatistics.fit(df.where("split = 'train'"), [*rates.values(), *counts.values()])
        df = stats.encode(df, rates, counts, smoothing=100 if features == "smoothed" else 0)
    return df


def _matrix_sql(features: str) -> str:
    smoothing = 100 if features == "smoothed" else 0
    learned = {**RATE_FEATURES, **HOUR_RATE_FEATURES}
    names, keys, columns = FEATURE_SETS[features], [], []
    for f in names:
        if f in learned:
            keys.append(learned[f])
            columns.append(f'round({_rate_sql(learned[f], smoothing)}, 6) AS "{f}"')
        elif f in COUNT_FEATURES:
            keys.append(COUNT_FEATURES[f])
            columns.append(f'round({_volume_sql(COUNT_FEATURES[f])}, 6) AS "{f}"')
        elif f == "SPEED":
            columns.append('round("DISTANCE" / "SCHEDULED_TIME", 6) AS "SPEED"')
        elif f in ("HOUR_SIN", "HOUR_COS"):
            columns.append(f'round("{f}", 6) AS "{f}"')
        else:
            columns.append(f'"{f}"')
    keys = list(dict.fromkeys(keys))
    head = _stats_sql(*keys) + "\n" if keys else f"WITH {FEATURED}\n"
    tail = _joins_sql(*keys) if keys else "FROM featured"
    return f'{head}SELECT "DELAYED", split, {", ".join(columns)}\n{tail}'


def _register_matrix(name: str, features: str) -> None:
    @query(name, _matrix_sql(features))
    def matrix(spark, sf):
        return rounded(select_matrix(matrix_frame(spark, sf, features), features, keep=["split"]))


# Query names of the feature sets.
MATRIX_QUERIES = {
    "feature_matrix_6": "raw", "feature_matrix_12": "basic", "feature_matrix_16": "no_target_encoding",
    "feature_matrix_20": "full", "feature_matrix_smoothed": "smoothed",
}
for _name, _features in MATRIX_QUERIES.items():
    _register_matrix(_name, _features)


# ---------------------------------------------------------------- statistics and sketches that grow


def _history(spark: SparkSession, sf: str) -> StatisticsHistory:
    """A version per month, from one pass; January is taken out again, and September added once more from its own rows."""
    rows = add_route(labelled(spark, sf)).where("MONTH <= 9").select("MONTH", *_KEYS, "DELAYED")
    month = F.format_string("%02d", "MONTH")
    history = StatisticsHistory(spark, scratch_path(spark, "history"), _KEYS)
    history.add_all(rows, month)
    history.remove("01")
    history.add("09", rows.where("MONTH = 9"))
    return history


@query("statistics_history", f"""
WITH {FEATURED}, rows AS (SELECT * FROM featured WHERE "MONTH" BETWEEN 2 AND 9)
SELECT '' AS key_name, CAST(NULL AS VARCHAR) AS key, SUM("DELAYED")::BIGINT AS positives, COUNT(*) AS n FROM rows
{" ".join(f"""UNION ALL SELECT '{k}', "{k}", SUM("DELAYED")::BIGINT, COUNT(*) FROM rows GROUP BY "{k}\"""" for k in _KEYS)}""")
def statistics_history(spark, sf):
    """Sums of eight saved months, merged without their rows."""
    return _history(spark, sf).current().table.select("key_name", "key", "positives", "n")


@query("target_encode_recent", f"""
WITH {FEATURED}, stats AS (SELECT "ROUTE", AVG("DELAYED") AS rate FROM featured WHERE "MONTH" BETWEEN 5 AND 9 GROUP BY 1),
overall AS (SELECT AVG("DELAYED") AS rate FROM featured WHERE "MONTH" BETWEEN 5 AND 9)
SELECT split, "ROUTE", "DELAYED", round(coalesce(s.rate, o.rate), 6) AS "ROUTE_DELAY_RATE"
FROM (SELECT split, f."ROUTE", "DELAYED", s.rate FROM featured AS f LEFT JOIN stats AS s ON s."ROUTE" = f."ROUTE") AS s, overall AS o""")
def target_encode_recent(spark, sf):
    """Features from the last five saved months only."""
    df = add_route(labelled(spark, sf)).select("split", "ROUTE", "DELAYED")
    return rounded(_history(spark, sf).current(since="05").encode(df, {"ROUTE_DELAY_RATE": "ROUTE"}))


_SKETCHED = ("ROUTE", "DESTINATION_AIRPORT", "SCHEDULED_DEPARTURE")


@query("distinct_sketches", f"""
WITH {FEATURED}, exact AS (
  SELECT split, {", ".join(f'COUNT(DISTINCT "{c}") AS "{c}"' for c in _SKETCHED)} FROM featured GROUP BY split)
{" UNION ALL ".join(f"""SELECT split, '{c}' AS "column", "{c}" AS exact, true AS within_bound FROM exact""" for c in _SKETCHED)}""")
def distinct_sketches(spark, sf):
    """Sketches stored per month, merged per split without the rows, beside the exact numbers: within three standard errors."""
    rows = add_route(labelled(spark, sf)).select("split", "MONTH", *_SKETCHED)
    path = scratch_path(spark, "sketches")
    pf.distinct_sketches(rows, _SKETCHED, ["split", "MONTH"]).write.parquet(path)
    merged = pf.sketch_counts(pf.merge_sketches(spark.read.parquet(path), _SKETCHED, ["split"]), _SKETCHED, ["split"])
    exact = rows.groupBy("split").agg(*[F.count_distinct(c).alias(c) for c in _SKETCHED])
    error = 3 * 1.04 / 2 ** (pf.SKETCH_BITS / 2)
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("exact"), (F.abs(F.col(f"{c}_distinct") - F.col(c)) <= error * F.col(c) + 0.5).alias("within_bound"))
        for c in _SKETCHED
    ]
    return exact.join(merged, "split").select("split", F.inline(F.array(*cells)))


@query("split_xy", f"""
WITH {LABELLED} SELECT 'features' AS part, COUNT(*) AS n, SUM("DISTANCE")::DOUBLE AS total FROM labelled
UNION ALL SELECT 'label', COUNT(*), SUM("DELAYED")::DOUBLE FROM labelled""")
def split_xy_query(spark, sf):
    """Features and label as two frames: each with all rows, neither with a column of the other."""
    x, y = split_xy(labelled(spark, sf))
    parts = [("features", x, "DISTANCE"), ("label", y, "DELAYED")]
    if "DELAYED" in x.columns or y.columns != ["DELAYED"]:
        raise ValueError("a column is on the wrong side")
    a, b = (df.agg(F.lit(name).alias("part"), F.count("*").alias("n"), F.sum(c).cast("double").alias("total")).select("part", "n", "total") for name, df, c in parts)
    return a.unionByName(b)
