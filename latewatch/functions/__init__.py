from latewatch.functions.scalar import (
    band_right_closed,
    classify,
    cyclic,
    dep_hour,
    event_time,
    exceeds,
    flight_id,
    hash_hex,
    is_late_night,
    is_long_haul,
    is_peak,
    is_weekend,
    label_gt,
    log_count,
    percent,
    ratio_or_zero,
    route,
    safe_ratio,
    severity,
    short_name,
    truth_json,
    truth_path,
    truth_time,
    whole_number,
)

bucketize_right = band_right_closed

__all__ = [
    "band_right_closed", "bucketize_right", "classify", "cyclic", "dep_hour", "event_time", "exceeds",
    "flight_id", "hash_hex", "is_late_night", "is_long_haul", "is_peak", "is_weekend", "label_gt",
    "log_count", "percent", "ratio_or_zero", "route", "safe_ratio", "severity", "short_name",
    "truth_json", "truth_path", "truth_time", "whole_number",
]
