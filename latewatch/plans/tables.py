"""The driver tables seen as flights and as scored events, in Spark and as CTEs for the SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch.operators.clean import clean, select_model_columns, with_label
from latewatch.operators.splits import temporal_split


# Columns of the test tables that are read here. A known schema saves a footer-reading job per table.
TABLES = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flight per line item. Join strategies are left to the optimizer: orders and suppliers grow with the data."""
    line = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.selectExpr(
        "year(l_shipdate) AS YEAR", "month(l_shipdate) AS MONTH", "day(l_shipdate) AS DAY",
        "weekday(l_shipdate) + 1 AS DAY_OF_WEEK",
        "concat('A', l_partkey % 14) AS AIRLINE",
        "n_name AS ORIGIN_AIRPORT",
        "concat('D', o_custkey % 400) AS DESTINATION_AIRPORT",
        "CAST((l_partkey % 24) * 100 + l_orderkey % 60 AS INT) AS SCHEDULED_DEPARTURE",
        "CASE WHEN l_orderkey % 101 <> 0 THEN l_quantity * 12 + 30 END AS SCHEDULED_TIME",
        "l_quantity * 100 AS DISTANCE",
        "CASE WHEN l_orderkey % 97 <> 0 "
        "THEN CAST((l_orderkey * 7 + l_partkey * 13 + l_suppkey * 3) % 90 - 50 AS DOUBLE) END AS ARRIVAL_DELAY",
        "CAST(l_partkey % 50 = 0 AS INT) AS CANCELLED",
        "CAST(l_suppkey % 50 = 1 AS INT) AS DIVERTED",
        "l_orderkey AS FLIGHT_KEY",
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(flights(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean flights with label and split, in modelling columns."""
    return temporal_split(select_model_columns(with_label(cleaned(spark, sf_dir))))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scored row per event. Scores have three digits, so many rows tie."""
    drawn = table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "event_type", "CAST(event_id % 2 AS INT) AS version",
        "((CAST(round(value * 100) AS BIGINT) * 7 + user_id * 13 + (event_id % 2) * 331) % 1000) / 1000D AS p",
    )
    return drawn.selectExpr(
        "CAST(event_id AS STRING) AS id", "event_id AS seq", "ts", "version", "event_type AS segment",
        "p AS probability",
        "CAST((event_id * 7919) % 1000 "
        "< floor(p * 500) + 150 + CASE WHEN event_type = 'error' THEN 150 ELSE 0 END AS INT) AS label",
    )


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth of the scored rows: some never arrive, some arrive days late."""
    s = scored(spark, sf_dir).where(F.col("seq") % 17 != 0)
    delay = F.when(F.col("seq") % 53 == 0, 3 * 86400).otherwise(F.col("seq") % 7200)
    return s.select("id", "label", (F.col("ts") + F.make_dt_interval(secs=delay)).alias("truth_ts"))


FLIGHTS = """
flights AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS "YEAR", CAST(month(l_shipdate) AS INTEGER) AS "MONTH",
         CAST(day(l_shipdate) AS INTEGER) AS "DAY", CAST(isodow(l_shipdate) AS INTEGER) AS "DAY_OF_WEEK",
         'A' || CAST(l_partkey % 14 AS VARCHAR) AS "AIRLINE",
         n_name AS "ORIGIN_AIRPORT",
         'D' || CAST(o_custkey % 400 AS VARCHAR) AS "DESTINATION_AIRPORT",
         CAST((l_partkey % 24) * 100 + l_orderkey % 60 AS INTEGER) AS "SCHEDULED_DEPARTURE",
         CASE WHEN l_orderkey % 101 <> 0 THEN l_quantity * 12 + 30 END AS "SCHEDULED_TIME",
         l_quantity * 100 AS "DISTANCE",
         CASE WHEN l_orderkey % 97 <> 0
              THEN CAST((l_orderkey * 7 + l_partkey * 13 + l_suppkey * 3) % 90 - 50 AS DOUBLE) END AS "ARRIVAL_DELAY",
         CAST(l_partkey % 50 = 0 AS INTEGER) AS "CANCELLED",
         CAST(l_suppkey % 50 = 1 AS INTEGER) AS "DIVERTED",
         l_orderkey AS "FLIGHT_KEY"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
)"""

CLEANED = FLIGHTS + """,
cleaned AS (
  SELECT * FROM flights
  WHERE "CANCELLED" = 0 AND "DIVERTED" = 0 AND "ARRIVAL_DELAY" IS NOT NULL
    AND "SCHEDULED_TIME" IS NOT NULL AND "DISTANCE" IS NOT NULL
)"""

LABELLED = CLEANED + """,
labelled AS (
  SELECT "MONTH", "DAY", "DAY_OF_WEEK", "SCHEDULED_DEPARTURE", "AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT",
         "DISTANCE", "SCHEDULED_TIME", CAST("ARRIVAL_DELAY" > 15 AS INTEGER) AS "DELAYED",
         CASE WHEN "MONTH" <= 9 THEN 'train' WHEN "MONTH" = 10 THEN 'val'
              WHEN "MONTH" = 11 THEN 'test' ELSE 'prod' END AS split
  FROM cleaned
)"""

FEATURED = LABELLED + """,
hours AS (
  SELECT *, CAST("SCHEDULED_DEPARTURE" // 100 AS INTEGER) AS "DEP_HOUR",
         "ORIGIN_AIRPORT" || '_' || "DESTINATION_AIRPORT" AS "ROUTE"
  FROM labelled
),
featured AS (
  SELECT *, sin(2 * pi() * "DEP_HOUR" / 24) AS "HOUR_SIN", cos(2 * pi() * "DEP_HOUR" / 24) AS "HOUR_COS",
         CAST("DEP_HOUR" BETWEEN 6 AND 9 OR "DEP_HOUR" BETWEEN 16 AND 20 AS INTEGER) AS "IS_PEAK_HOUR",
         CAST("DAY_OF_WEEK" >= 6 AS INTEGER) AS "IS_WEEKEND",
         CAST("DEP_HOUR" >= 21 AS INTEGER) AS "IS_LATE_NIGHT",
         CAST("DISTANCE" > 1500 AS INTEGER) AS "IS_LONG_HAUL",
         CAST(CASE WHEN "DISTANCE" <= 0 THEN NULL WHEN "DISTANCE" <= 500 THEN 0 WHEN "DISTANCE" <= 1500 THEN 1
                   WHEN "DISTANCE" <= 5000 THEN 2 END AS INTEGER) AS "DISTANCE_BUCKET"
  FROM hours
)"""

SCORED = """
draws AS (
  SELECT event_id, ts, event_type, CAST(event_id % 2 AS INTEGER) AS version,
         ((CAST(round(value * 100) AS BIGINT) * 7 + user_id * 13 + (event_id % 2) * 331) % 1000)
           / CAST(1000 AS DOUBLE) AS p
  FROM events
),
scored AS (
  SELECT CAST(event_id AS VARCHAR) AS id, event_id AS seq, ts, version, event_type AS segment, p AS probability,
         CAST((event_id * 7919) % 1000
              < floor(p * 500) + 150 + CASE WHEN event_type = 'error' THEN 150 ELSE 0 END AS INTEGER) AS label
  FROM draws
)"""

TRUTH = SCORED + """,
truth AS (
  SELECT id, label,
         ts + to_seconds(CASE WHEN seq % 53 = 0 THEN 3 * 86400 ELSE seq % 7200 END) AS truth_ts
  FROM scored WHERE seq % 17 <> 0
)"""
