"""Alarm states as a stream: every period of every group, also one without data, once the watermark has passed it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from latewatch.operators.monitor import ALARM_PERIOD_SECONDS, ALARM_THRESHOLD

_STATE = "starts array<bigint>, sums array<double>, counts array<bigint>, next bigint"


def alarm_stream(
    metrics: DataFrame, period_seconds: int = ALARM_PERIOD_SECONDS, threshold: float = ALARM_THRESHOLD, treat_missing: str = "breaching",
    by: Sequence[str] = (), ts: str = "window_start", value: str = "f1_score",
) -> DataFrame:
    """(by…, period_start, average, in_alarm) of a stream of metrics with a watermark on ``ts``. Use append mode.

    A group starts with its first metric. From there on each period is emitted when the watermark passes its end, whether it has data or not: with data it alarms
    if its average is at or below the threshold, without data ``treat_missing`` decides as in the batch ``alarm``. State per group: the sums
    of the periods that the watermark has not passed, and the next period to emit; a timer at its end wakes the group although nothing arrives.
    """
    if treat_missing not in ("breaching", "notBreaching", "missing"):
        raise ValueError(f"unknown treat_missing: {treat_missing}")
    no_data = {"breaching": True, "notBreaching": False, "missing": None}[treat_missing]
    keys = [metrics.schema[c] for c in by] or [T.StructField("_all", T.IntegerType())]
    step = int(period_seconds) * 1_000_000
    schema = T.StructType([*keys, T.StructField("_start", T.LongType()), T.StructField("average", T.DoubleType()), T.StructField("in_alarm", T.BooleanType())])

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        open_, after = {}, None
        if state.exists:
            starts, sums, counts, after = state.get
            open_ = {s: (x, n) for s, x, n in zip(starts, sums, counts, strict=True)}
        for part in parts:
            known = part[part["_value"].notna()]
            for start, rows in known.groupby(known["_start"])["_value"]:
                x, n = open_.get(int(start), (0.0, 0))
                open_[int(start)] = (x + float(rows.sum()), n + len(rows))
            if len(part):  # a metric without a value begins a group, too
                first = int(part["_start"].min())
                after = first if after is None else min(after, first)
        passed = state.getCurrentWatermarkMs() * 1000
        out = []
        while after is not None and after + step <= passed:
            x, n = open_.pop(after, (0.0, 0))
            out.append((*key, after, x / n if n else None, (x / n <= threshold) if n else no_data))
            after += step
        if after is not None:
            state.update((list(open_), [x for x, _ in open_.values()], [n for _, n in open_.values()], after))
            state.setTimeoutTimestamp((after + step) // 1000)
        if out:
            frame = pd.DataFrame(out, columns=schema.names)
            yield frame.astype({"average": "Float64", "in_alarm": "boolean"})

    rows = metrics if by else metrics.withColumn("_all", F.lit(0))
    at = F.unix_micros(F.col(ts))
    rows = rows.select(*[k.name for k in keys], ts, (at - F.pmod(at, F.lit(step))).alias("_start"), F.col(value).cast("double").alias("_value"))
    out = rows.groupBy(*[k.name for k in keys]).applyInPandasWithState(run, schema, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(*by, F.timestamp_micros("_start").alias("period_start"), "average", "in_alarm")
