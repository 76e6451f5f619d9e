"""Explicit schemas and named feature lists. Nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the raw table, in file order, with the type each is used as.
FLIGHT_COLUMNS = {
    "YEAR": "int", "MONTH": "int", "DAY": "int", "DAY_OF_WEEK": "int",
    "AIRLINE": "string", "FLIGHT_NUMBER": "int", "TAIL_NUMBER": "string",
    "ORIGIN_AIRPORT": "string", "DESTINATION_AIRPORT": "string",
    "SCHEDULED_DEPARTURE": "int", "DEPARTURE_TIME": "int", "DEPARTURE_DELAY": "double",
    "TAXI_OUT": "double", "WHEELS_OFF": "int", "SCHEDULED_TIME": "double",
    "ELAPSED_TIME": "double", "AIR_TIME": "double", "DISTANCE": "double",
    "WHEELS_ON": "int", "TAXI_IN": "double", "SCHEDULED_ARRIVAL": "int",
    "ARRIVAL_TIME": "int", "ARRIVAL_DELAY": "double", "DIVERTED": "int",
    "CANCELLED": "int", "CANCELLATION_REASON": "string", "AIR_SYSTEM_DELAY": "double",
    "SECURITY_DELAY": "double", "AIRLINE_DELAY": "double", "LATE_AIRCRAFT_DELAY": "double",
    "WEATHER_DELAY": "double",
}
AIRLINE_COLUMNS = {"IATA_CODE": "string", "AIRLINE": "string"}
AIRPORT_COLUMNS = {
    "IATA_CODE": "string", "AIRPORT": "string", "CITY": "string", "STATE": "string",
    "COUNTRY": "string", "LATITUDE": "double", "LONGITUDE": "double",
}
SPLIT_COLUMNS = {
    "MONTH": "int", "DAY": "int", "DAY_OF_WEEK": "int", "SCHEDULED_DEPARTURE": "int",
    "AIRLINE": "string", "ORIGIN_AIRPORT": "string", "DESTINATION_AIRPORT": "string",
    "DISTANCE": "double", "SCHEDULED_TIME": "double", "DELAYED": "int",
}


_TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "string": T.StringType(), "timestamp": T.TimestampType(),
}


def schema_of(columns: dict[str, str]) -> T.StructType:
    """StructType of a name → type mapping."""
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in columns.items()])


def string_schema(columns: dict[str, str]) -> T.StructType:
    """The same columns, all text: the layout of an external table before it is typed."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in columns])


# The named feature lists.
FEATURE_SETS: dict[str, list[str]] = {
    "raw": [
        "MONTH", "DAY_OF_WEEK", "DEP_HOUR", "DISTANCE", "SCHEDULED_TIME", "IS_WEEKEND",
    ],
    "basic": [
        "MONTH", "DAY", "DAY_OF_WEEK", "DEP_HOUR", "HOUR_SIN", "HOUR_COS", "IS_PEAK_HOUR", "IS_WEEKEND",
        "DISTANCE", "SCHEDULED_TIME", "IS_LONG_HAUL", "DISTANCE_BUCKET",
    ],
    "no_target_encoding": [
        "MONTH", "DAY", "DAY_OF_WEEK", "DEP_HOUR", "SCHEDULED_DEPARTURE",
        "HOUR_SIN", "HOUR_COS", "IS_PEAK_HOUR", "IS_WEEKEND",
        "DISTANCE", "SCHEDULED_TIME", "IS_LONG_HAUL", "DISTANCE_BUCKET",
        "ORIGIN_FLIGHTS", "DEST_FLIGHTS", "ROUTE_FLIGHTS",
    ],
    "full": [
        "MONTH", "DAY", "DAY_OF_WEEK", "DEP_HOUR", "SCHEDULED_DEPARTURE",
        "HOUR_SIN", "HOUR_COS", "IS_PEAK_HOUR", "IS_WEEKEND",
        "DISTANCE", "SCHEDULED_TIME", "IS_LONG_HAUL", "DISTANCE_BUCKET",
        "AIRLINE_DELAY_RATE", "ORIGIN_DELAY_RATE", "DEST_DELAY_RATE", "ROUTE_DELAY_RATE",
        "ORIGIN_FLIGHTS", "DEST_FLIGHTS", "ROUTE_FLIGHTS",
    ],
    "smoothed": [
        "MONTH", "DAY_OF_WEEK", "SCHEDULED_TIME", "DISTANCE", "DEP_HOUR",
        "HOUR_SIN", "HOUR_COS", "IS_PEAK_HOUR", "IS_LATE_NIGHT", "IS_WEEKEND",
        "SPEED", "IS_LONG_HAUL",
        "AIRLINE_DELAY_RATE", "ORIGIN_DELAY_RATE", "DEST_DELAY_RATE", "ROUTE_DELAY_RATE",
        "ORIGIN_FLIGHTS", "DEST_FLIGHTS", "ROUTE_FLIGHTS", "HOUR_DELAY_RATE",
    ],
}

# Features that hold whole numbers; all others are doubles.
INTEGER_FEATURES = {
    "MONTH", "DAY", "DAY_OF_WEEK", "DEP_HOUR", "SCHEDULED_DEPARTURE", "DISTANCE_BUCKET",
    "IS_PEAK_HOUR", "IS_LATE_NIGHT", "IS_WEEKEND", "IS_LONG_HAUL",
}


def matrix_schema(features: list[str], label: str | None = "DELAYED") -> T.StructType:
    """Positional schema of a headerless matrix: the label first, then the features."""
    fields = [] if label is None else [T.StructField(label, T.IntegerType(), True)]
    for name in features:
        kind = T.IntegerType() if name in INTEGER_FEATURES else T.DoubleType()
        fields.append(T.StructField(name, kind, True))
    return T.StructType(fields)


TRUTH_SCHEMA = T.StructType([
    T.StructField("groundTruthData", T.StructType([
        T.StructField("data", T.StringType()), T.StructField("encoding", T.StringType())])),
    T.StructField("eventMetadata", T.StructType([T.StructField("eventId", T.StringType())])),
    T.StructField("eventVersion", T.StringType()),
    T.StructField("uploadMicros", T.LongType()),  # microseconds since 1970; only in tables of many uploads
])
