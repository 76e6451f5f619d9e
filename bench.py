"""Headline timings: prints one JSON line. BENCH_SF_DIR names the tables, BENCH_CPUS the local cores."""

from __future__ import annotations

import json
import os
import sys
import time

from latewatch.plans import QUERIES
from latewatch.runtime import build_session, clean_scratch

HEADLINE = [
    "clean_funnel", "target_summary", "rate_by_airline", "rate_by_time", "top_airlines", "histogram_delay",
    "median_distance", "median_price_by_flag", "split_summary", "split_detail", "stratified_split", "row_features",
    "speed_feature", "flagship", "target_encode", "target_encode_smoothed", "volume_encode", "feature_matrix_20",
    "confusion", "evaluate_by_split", "roc_auc", "roc_curve", "pr_curve", "best_threshold", "threshold_sweep",
    "compare_models", "quality_gate", "latest_version", "ground_truth_join", "window_quality", "f1_alarm",
    "io_flights_csv", "io_features_parquet", "stream_quality", "train_score_gbt",
]


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "latewatch-bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(cpus), spark__ui__enabled="false", spark__driver__memory="8g",
        spark__sql__files__maxPartitionBytes="4m", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # one untimed query per code path the rest relies on: JVM start-up is not what is measured
    for name in ("flagship", "roc_curve"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name:26s} {seconds[name]:8.3f}", file=sys.stderr)
        clean_scratch(spark)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
