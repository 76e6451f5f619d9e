"""Column functions. Every one is a built-in Catalyst expression, so a whole feature row stays in one codegen stage."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Rush-hour ranges (inclusive), distance band edges, severity limits in percent.
PEAK_RANGES = ((6, 9), (16, 20))
DISTANCE_EDGES = (0, 500, 1500, 5000)
SEVERITY_HIGH = 20
SEVERITY_MEDIUM = 15


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dep_hour(hhmm: ColumnLike) -> Column:
    """Hour of an HHMM integer; 2400 stays hour 24."""
    return F.floor(_col(hhmm) / 100).cast("int")


def cyclic(c: ColumnLike, period: float = 24) -> tuple[Column, Column]:
    """(sin, cos) of the position within ``period``."""
    angle = F.lit(2 * math.pi) * _col(c) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def is_peak(hour: ColumnLike, ranges: Sequence[tuple[int, int]] = PEAK_RANGES) -> Column:
    hit = F.lit(False)
    for lo, hi in ranges:
        hit = hit | _col(hour).between(lo, hi)
    return hit.cast("int")


def is_weekend(day_of_week: ColumnLike) -> Column:
    """1 for Saturday and Sunday, with Monday = 1."""
    return (_col(day_of_week) >= 6).cast("int")


def is_late_night(hour: ColumnLike) -> Column:
    return (_col(hour) >= 21).cast("int")


def is_long_haul(distance: ColumnLike, limit: float = 1500) -> Column:
    return (_col(distance) > limit).cast("int")


def band_right_closed(
    c: ColumnLike,
    edges: Sequence[float] = DISTANCE_EDGES,
    labels: Sequence[int] | None = None,
    strict: bool = False,
) -> Column:
    """Integer label of the band ``(edges[i], edges[i + 1]]``.

    NULL input stays NULL. A value outside all bands is NULL, or with ``strict`` stops the query.
    """
    x = _col(c)
    labels = list(labels) if labels is not None else list(range(len(edges) - 1))
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per band")
    out = F.when(x.isNull() | (x <= edges[0]), F.lit(None).cast("int"))
    for upper, name in zip(edges[1:], labels):
        out = out.when(x <= upper, F.lit(name))
    if not strict:
        return out
    outside = x.isNotNull() & ((x <= edges[0]) | (x > edges[-1]))
    message = F.concat(F.lit("value outside all bands: "), x.cast("string"))
    return F.when(outside, F.raise_error(message).cast("int")).otherwise(out)


def safe_ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """numerator / denominator, NULL where the denominator is 0 or NULL."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def ratio_or_zero(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """numerator / denominator with 0 for an empty denominator (the usual rule for precision and recall)."""
    return F.coalesce(safe_ratio(numerator, denominator), F.lit(0.0))


def percent(part: ColumnLike, whole: ColumnLike, digits: int | None = None) -> Column:
    value = safe_ratio(_col(part) * 100, whole)
    return value if digits is None else F.round(value, digits)


def log_count(n: ColumnLike) -> Column:
    """log(1 + n), with a missing count taken as 0."""
    return F.log1p(F.coalesce(_col(n), F.lit(0)).cast("double"))


def route(origin: ColumnLike, destination: ColumnLike) -> Column:
    """origin_destination; NULL if either end is NULL (``concat``, not ``concat_ws``)."""
    return F.concat(_col(origin), F.lit("_"), _col(destination))


def flight_id(
    year: int | Column,
    month: ColumnLike,
    day: ColumnLike,
    airline: ColumnLike,
    origin: ColumnLike,
    destination: ColumnLike,
    hhmm: ColumnLike,
) -> Column:
    """YYYY-MM-DD-AIRLINE-ORIGIN-DESTINATION-HHMM. Padding never truncates."""
    y = F.lit(year) if isinstance(year, int) else year
    return F.concat(
        y.cast("string"), F.lit("-"), F.format_string("%02d", _col(month)),
        F.lit("-"), F.format_string("%02d", _col(day)),
        F.lit("-"), _col(airline), F.lit("-"), _col(origin), F.lit("-"), _col(destination),
        F.lit("-"), F.format_string("%04d", _col(hhmm).cast("int")),
    )


def event_time(year: int | Column, month: ColumnLike, day: ColumnLike) -> Column:
    """Midnight UTC of the date as epoch seconds (double), whatever the session time zone."""
    y = F.lit(year) if isinstance(year, int) else year
    zero = F.lit(0)
    at = F.make_timestamp(y, _col(month), _col(day), zero, zero, zero, F.lit("UTC"))
    return F.unix_timestamp(at).cast("double")


def exceeds(c: ColumnLike, limit: float) -> Column:
    """``c > limit`` as a boolean in which a NULL counts as false."""
    return F.coalesce(_col(c) > limit, F.lit(False))


def label_gt(c: ColumnLike, limit: float = 15) -> Column:
    """1 if ``c > limit`` else 0; NULL stays NULL."""
    return (_col(c) > limit).cast("int")


def severity(rate: ColumnLike, high: float = SEVERITY_HIGH, medium: float = SEVERITY_MEDIUM) -> Column:
    x = _col(rate)
    return F.when(x > high, "high").when(x > medium, "medium").otherwise("low")


def short_name(name: ColumnLike, code: ColumnLike, width: int = 25) -> Column:
    return F.substring(F.coalesce(_col(name), _col(code)), 1, width)


def classify(probability: ColumnLike, threshold: float = 0.5) -> Column:
    return (_col(probability) >= threshold).cast("int")


def hash_hex(key: ColumnLike | Sequence[ColumnLike], seed: int | str = "") -> Column:
    """Seeded md5 of a row key. Hex digests order like numbers, so they serve as a shuffled order and as a
    uniform draw, the same on every run, executor and retry."""
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    parts = [F.lit(str(seed))] + [F.coalesce(_col(k).cast("string"), F.lit("\0")) for k in keys]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def truth_json(label: ColumnLike, event_id: ColumnLike) -> Column:
    """Nested ground-truth record as a JSON string."""
    return F.to_json(truth_struct(label, event_id))


def truth_struct(label: ColumnLike, event_id: ColumnLike) -> Column:
    return F.struct(
        F.struct(
            _col(label).cast("int").cast("string").alias("data"), F.lit("CSV").alias("encoding")
        ).alias("groundTruthData"),
        F.struct(_col(event_id).cast("string").alias("eventId")).alias("eventMetadata"),
        F.lit("0").alias("eventVersion"),
    )


# Folder layouts of ground-truth uploads and the patterns that read the time back, always in UTC. One upload
# lies under its own second; a table of uploads is partitioned by hour and keeps the time in each record.
TRUTH_PATH_FORMAT = "yyyy/MM/dd/HH/mmss"
TRUTH_PATH_PATTERN = r"(\d{4})/(\d{2})/(\d{2})/(\d{2})/(\d{2})(\d{2})\.jsonl"
TRUTH_HOUR_PATTERN = r"upload_date=(\d{4})-(\d{2})-(\d{2})/upload_hour=(\d{2})"


def format_utc(ts: ColumnLike, pattern: str) -> Column:
    """A timestamp printed in UTC, whatever the zone of the session."""
    return F.date_format(F.to_utc_timestamp(_col(ts).cast("timestamp"), F.current_timezone()), pattern)


def truth_path(ts: ColumnLike) -> Column:
    return F.concat(format_utc(ts, TRUTH_PATH_FORMAT), F.lit(".jsonl"))


def truth_time(path: ColumnLike) -> Column:
    """Upload time from a ground-truth file path of either layout; NULL when the path has no such part. The hour is all that
    the path of a table tells; ``flatten_truth`` reads the time kept in the record first."""

    def stamp(pattern: str, groups: int) -> Column:
        parts = [F.regexp_extract(_col(path), pattern, i).try_cast("int") for i in range(1, groups + 1)]
        parts += [F.lit(0)] * (6 - groups)
        return F.try_make_timestamp(*parts, F.lit("UTC"))

    return F.coalesce(stamp(TRUTH_PATH_PATTERN, 6), stamp(TRUTH_HOUR_PATTERN, 4))


def whole_number(text: ColumnLike, kind: str = "int") -> Column:
    """Text as an ``int`` or ``bigint`` if it is a whole number that fits, else NULL. No digit is lost on the way: a decimal holds any bigint."""
    number = _col(text).try_cast("decimal(38,18)")
    return F.when(number == F.floor(number), number.try_cast(kind))
