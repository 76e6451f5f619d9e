from latewatch.streaming.alarms import alarm_stream
from latewatch.streaming.streams import (
    close_input, close_truth, coverage_stream, join_streams, match_stream, matches_stream, quality_stream, run_available, scored_stream, status_stream, truth_stream,
    window_quality_stream,
)

__all__ = [
    "alarm_stream", "close_input", "close_truth", "coverage_stream", "join_streams", "match_stream", "matches_stream", "quality_stream", "run_available",
    "scored_stream", "status_stream", "truth_stream", "window_quality_stream",
]
