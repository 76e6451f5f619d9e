"""Structured Streaming: scored rows, late ground truth, and their windowed quality."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from latewatch.operators.metrics import metrics_from_counts
from latewatch.operators.model import score
from latewatch.operators.monitor import _seconds
from latewatch.schemas import TRUTH_SCHEMA, schema_of
from latewatch.sources.readers import flatten_truth
from latewatch.sources.writers import write_ground_truth

SCORED_SCHEMA = schema_of({"id": "string", "ts": "timestamp", "probability": "double"})


def scored_stream(
    spark: SparkSession, path: str, schema: T.StructType = SCORED_SCHEMA, fmt: str = "json",
    model: PipelineModel | None = None, watermark: str = "1 hour", ts: str = "ts",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of scored rows from a folder. With ``model`` the files hold features, scored on the way in."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(path)
    if model is not None:
        rows = score(model, rows)
    return rows.withWatermark(ts, watermark)


def truth_stream(
    spark: SparkSession, path: str, watermark: str = "1 hour", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of (id, label, truth_ts) from nested JSON lines; the event time is read from the file path."""
    reader = (
        spark.readStream.schema(TRUTH_SCHEMA)
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return flatten_truth(reader.json(path)).withWatermark("truth_ts", watermark)


# Parts that the scored rows of one id are spread over: ids restart with every run, so low ones are hot.
STATE_SALTS = 4


def join_streams(scored: DataFrame, truth: DataFrame, max_delay: str = "1 day", salts: int = STATE_SALTS) -> DataFrame:
    """Inner join of streams (or batch frames) on id within a time range; the range lets both sides forget old rows.

    ``salts`` spreads the scored rows of one id over that many state partitions; the truth rows, one per label, are kept once
    per salt. A truth row is paired with every scored row in range, which in a stream cannot wait for a later one.
    """
    t = truth.withColumnRenamed("id", "_id")
    on = F.col("id") == F.col("_id")
    if salts > 1:
        scored = scored.withColumn("_salt", F.pmod(F.xxhash64("id", "ts", "probability"), F.lit(salts)).cast("int"))
        t = t.withColumn("_salt_r", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
        on = on & (F.col("_salt") == F.col("_salt_r"))
    on = (
        on
        & (F.col("truth_ts") >= F.col("ts"))
        & (F.col("truth_ts") <= F.col("ts") + F.expr(f"INTERVAL {max_delay}"))
    )
    return scored.join(t, on, "inner").drop("_id", "_salt", "_salt_r")


def match_stream(
    scored: DataFrame, truth: DataFrame, max_delay: str = "1 day", salts: int = STATE_SALTS, ts: str = "ts", truth_ts: str = "truth_ts",
) -> DataFrame:
    """Each truth row with the latest scored row before it, as ``join_ground_truth`` pairs them in a batch. Use append mode.

    The time axis is cut into pieces of ``max_delay``. Four stateful steps in one query: the scored rows and the truth rows of each id and piece are gathered
    in the order of time, a piece of truth is joined with the scored rows of its piece and with the last one of the piece before, and the greatest that
    ``salts`` parts and both pieces know is kept. A truth row looks up its place by halving, so that an id with many rows in range costs no pair of each two.
    Matches are emitted piece by piece, once the watermark rules out any other for the piece (at most twice ``max_delay`` behind the slower stream's).
    State: one row per id, part and open piece. Equal truth rows count once.
    """
    own, others = list(scored.columns), [c for c in truth.columns if c != "id"]
    names = {c: f"_t_{c}" if c in own and c != truth_ts else c for c in others}
    piece = f"{_seconds(max_delay)} seconds"
    row = F.struct(F.col(ts).alias("_ts"), F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"))
    asked = F.struct(F.col(truth_ts).alias("_ts"), F.struct(*[F.col(f"`{c}`").alias(names[c]) for c in others]).alias("_row"))
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in own]), F.lit(salts)).cast("int")
    runs = scored.groupBy("id", part.alias("_salt"), F.window(ts, piece).alias("_w")).agg(F.array_sort(F.collect_list(row)).alias("_runs"))
    # in its own piece all scored rows of an id count, in the next one the last of them
    copies = F.array(F.struct(F.lit(0).alias("after"), F.col("_runs").alias("runs")), F.struct(F.lit(1).alias("after"), F.slice("_runs", -1, 1).alias("runs")))
    runs = runs.select(F.col("id").alias("_id"), "_salt", F.window_time("_w").alias("_until"), F.explode(copies).alias("_c"))
    runs = runs.select("_id", "_salt", "_until", (F.unix_micros("_until") + F.col("_c.after") * F.lit(_seconds(max_delay) * 1_000_000).cast("long")).alias("_piece"), "_c.runs")
    labels = truth.groupBy("id", F.window(truth_ts, piece).alias("_w")).agg(_distinct(F.collect_list(asked)).alias("_asked"))
    labels = labels.select("id", F.window_time("_w").alias("_truth_until"), "_asked", F.explode(F.array(*[F.lit(i) for i in range(salts)])).alias("_salt_r"))
    on = (
        (F.col("id") == F.col("_id")) & (F.col("_salt_r") == F.col("_salt")) & (F.unix_micros("_truth_until") == F.col("_piece"))
        & (F.col("_truth_until") >= F.col("_until")) & (F.col("_truth_until") <= F.col("_until") + F.expr(f"INTERVAL {piece}"))
    )
    known = labels.join(runs, on, "inner").select("id", "_truth_until", "_asked", _latest_of("_asked", "runs").alias("_found"))
    best = known.groupBy("id", "_truth_until").agg(F.first("_asked").alias("_asked"), F.collect_list("_found").alias("_all"))
    greatest = F.aggregate("_all", F.transform("_asked", lambda _: F.lit(None).cast(known.schema["_found"].dataType.elementType)), _greater)
    pairs = best.select(F.explode(F.arrays_zip(F.col("_asked").alias("t"), greatest.alias("s"))).alias("_p"))
    within = F.col("_p.t._ts") <= F.col("_p.s._ts") + F.expr(f"INTERVAL {piece}")  # in seconds, as in a batch, whatever the zone
    return pairs.where(within).select("_p.s._row.*", *[F.col("_p.t._row")[names[c]].alias(names[c]) for c in others])


def _distinct(rows: Column) -> Column:
    """An array in order, without repeats."""
    alone = lambda sorted_: F.filter(sorted_, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(sorted_, i - 1)))
    return F.transform(F.array(F.array_sort(rows)), alone)[0]


def _latest_of(asked: str, runs: str) -> Column:
    """For each of the rows ``asked`` the last of the sorted ``runs`` up to its time, or NULL; found by halving."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(runs) + 1)).cast("int"))

    def last(t: Column) -> Column:
        def halve(a: Column, _: Column) -> Column:
            middle = F.floor((a["low"] + a["high"]) / 2).cast("int")
            after = F.get(runs, middle)["_ts"] > t["_ts"]
            return (
                F.when(a["low"] >= a["high"], a)
                .when(after, F.struct(a["low"].alias("low"), middle.alias("high")))
                .otherwise(F.struct((middle + 1).alias("low"), a["high"].alias("high")))
            )

        whole = F.struct(F.lit(0).alias("low"), F.size(runs).alias("high"))
        return F.aggregate(steps, whole, halve, lambda a: F.get(runs, a["low"] - 1))

    return F.transform(asked, last)


def _greater(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.greatest(x, y))


def matches_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_delay: str, watermark: str = "1 hour", ts: str = "ts",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The written output of ``match_stream`` as a stream by scored time.

    A match is written up to ``max_delay`` after its scored row, so that much is added to the watermark: nothing that ``match_stream`` still writes
    is late here.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).withWatermark(ts, f"{_seconds(max_delay) + _seconds(watermark)} seconds")


# Scores are counted in this many cells between 0 and 1: those printed to three digits have a cell each.
SCORE_CELLS = 1000


def auc_of_cells(cells: Column) -> Column:
    """``auc`` and ``auc_error`` of an array of structs (cell, pos, neg, low, high), one per cell of scores.

    A pair of rows in one cell counts one half. That is exact where the cell holds a single score; elsewhere the truth differs by at most one
    half of its pairs, which ``auc_error`` adds up. Both are NULL if a class is absent.
    """
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("below", "won", "doubt", "p")])

    def step(a: Column, x: Column) -> Column:
        pairs = x["pos"] * x["neg"] / F.lit(2.0)
        return F.struct(
            (a["below"] + x["neg"]).alias("below"), (a["won"] + x["pos"] * a["below"] + pairs).alias("won"),
            (a["doubt"] + F.when(x["low"] < x["high"], pairs).otherwise(0.0)).alias("doubt"), (a["p"] + x["pos"]).alias("p"),
        )

    def share(a: Column) -> Column:
        pairs = F.nullif(a["p"] * a["below"], F.lit(0.0))
        return F.struct((a["won"] / pairs).alias("auc"), (a["doubt"] / pairs).alias("auc_error"))

    return F.aggregate(F.array_sort(cells), zero, step, share)


def window_quality_stream(
    joined: DataFrame, every: str = "1 hour", threshold: float = 0.5, by: Sequence[str] = (), ts: str = "ts", score: str = "probability",
    label: str = "label", cells: int = SCORE_CELLS,
) -> DataFrame:
    """Confusion counts, metrics and AUC of rows with score and label, per tumbling window (and group). Use append mode; works on batch frames, too.

    Two stateful steps: rows are counted per window and cell of scores, then the at most ``cells`` + 1 counts of a window become one row. Counts of the
    threshold are exact; ``auc_error`` bounds what the cells cost the AUC (0 if no cell holds two scores, as with scores printed to three digits).
    """
    s, real = F.col(score), F.col(label) == 1
    hit = s >= threshold
    usable = joined.where(s.isNotNull() & F.col(label).isNotNull())
    counted = usable.groupBy(F.window(ts, every).alias("_w"), *by, F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), s)) * cells).cast("int").alias("_cell")).agg(
        F.count_if(real).alias("_pos"), F.count_if(~real).alias("_neg"), F.count_if(hit & real).alias("_tp"), F.count_if(hit & ~real).alias("_fp"),
        F.min(s).alias("_low"), F.max(s).alias("_high"),
    )
    cell = F.struct(*[F.col(f"_{c}").alias(c) for c in ("cell", "pos", "neg", "low", "high")])
    whole = counted.groupBy("_w", *by).agg(
        (F.sum("_neg") - F.sum("_fp")).alias("true_negative"), F.sum("_fp").alias("false_positive"),
        (F.sum("_pos") - F.sum("_tp")).alias("false_negative"), F.sum("_tp").alias("true_positive"), F.collect_list(cell).alias("_cells"),
    )
    out = metrics_from_counts(whole.withColumn("_auc", auc_of_cells(F.col("_cells"))))
    return out.select(*[c for c in out.columns if not c.startswith("_")], "_auc.auc", "_auc.auc_error", F.col("_w.start").alias("window_start"))


def quality_stream(
    scored: DataFrame, truth: DataFrame, every: str = "1 hour", max_delay: str = "1 day", threshold: float = 0.5,
    salts: int = STATE_SALTS, by: tuple[str, ...] = (),
) -> DataFrame:
    """``window_quality_stream`` of the joined streams, in one query. A truth row counts for every scored row in range; where ids are used
    again, write ``match_stream`` and evaluate ``matches_stream``.

    State: unmatched rows inside the time range, and the cell counts of open windows.
    """
    return window_quality_stream(join_streams(scored, truth, max_delay, salts), every, threshold, by)


MATCHED, LATE, UNMATCHED = "matched", "late", "unmatched"


def status_stream(scored: DataFrame, matches: DataFrame, max_delay: str = "1 day", ts: str = "ts", truth_ts: str = "truth_ts") -> DataFrame:
    """Every scored row with ``truth_ts`` of the first truth that belongs to it and its ``status``: matched within ``max_delay``, late, or unmatched.

    ``matches`` is a ``matches_stream`` of matches within a longer time: how long truth is waited for. Its watermark releases the scored
    rows without truth: a left outer join on the whole row, after one match per scored row is kept. Equal scored rows share their truth. A row that
    is found unmatched stays so, as all that could match it has been written before. Use append mode.
    """
    own = list(scored.columns)
    key = F.xxhash64(*[F.col(f"`{c}`") for c in own])
    first = matches.withColumn("_key_m", key).groupBy(F.col("id").alias("_id_m"), F.col(ts).alias("_ts_m"), "_key_m").agg(F.min(truth_ts).alias(truth_ts))
    on = (F.col("id") == F.col("_id_m")) & (F.col(ts) == F.col("_ts_m")) & (F.col("_key") == F.col("_key_m"))
    joined = scored.withColumn("_key", key).join(first, on, "left_outer")
    known = F.when(F.col(truth_ts) <= F.col(ts) + F.expr(f"INTERVAL {max_delay}"), MATCHED).otherwise(LATE)
    return joined.select(*own, truth_ts, F.when(F.col(truth_ts).isNull(), UNMATCHED).otherwise(known).alias("status"))


def coverage_stream(
    scored: DataFrame, matches: DataFrame, every: str = "1 hour", max_delay: str = "1 day", by: Sequence[str] = (), ts: str = "ts",
) -> DataFrame:
    """Per window (and group): all scored rows, and how many are matched, late and unmatched, which add up to them. Use append mode."""
    rows = status_stream(scored, matches, max_delay, ts)
    counts = rows.groupBy(F.window(ts, every).alias("_w"), *by).agg(
        F.count("*").alias("n_scored"), *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in (MATCHED, LATE, UNMATCHED)]
    )
    return counts.select(F.col("_w.start").alias("window_start"), *by, *[c for c in counts.columns if c.startswith("n_")])


def close_input(spark: SparkSession, path: str, schema: T.StructType, at: datetime, ts: str = "ts") -> None:
    """End a folder of Parquet files that a stream reads: one more row at the time ``at``, with '' and 0 in all other columns. The watermark then
    passes all before it, so that every window is emitted; its own never is.

    A filter that this row does not pass (Spark moves filters, and the test of a join key for NULL, below the watermark) would keep it from the watermark.
    """
    plain = {T.StringType(): "", T.TimestampType(): at}
    row = spark.range(1).select(*[
        F.lit(at if f.name == ts else plain.get(f.dataType, 0)).cast(f.dataType).alias(f.name) for f in schema
    ])
    row.write.mode("append").parquet(path)


def close_truth(spark: SparkSession, directory: str, at: datetime) -> None:
    """The same for a folder of ground truth: an upload at ``at`` (UTC) with id '' and label 0."""
    write_ground_truth(spark.range(1).selectExpr("'' AS id", "0 AS label"), directory, at)


# State grows with the rows inside a time range, which no heap is sized for: it is kept on disk, whatever the session's own setting.
# Counting the keys of a store for the progress report would cost one more lookup for each row. A restart needs the last two versions; a hundred
# would be kept. Each open store writes through two buffers of the stated size, outside of the heap.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "16",
    "spark.sql.streaming.stateStore.rocksdb.maxWriteBufferNumber": "2",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}


def run_available(
    stream: DataFrame, output: str, checkpoint: str, mode: str = "append", state_partitions: int | None = None
) -> StreamingQuery:
    """Process all data present now into Parquet files and stop; rerunning continues from the checkpoint.

    The state is kept on disk. ``state_partitions`` fixes how many parts it is kept in. Both are settled by the first run of a checkpoint
    and apart from the settings of the session, which are left as they were.
    """
    conf, settings = stream.sparkSession.conf, dict(STATE_ON_DISK)
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {key: conf.get(key, None) for key in settings}
    writer = (
        stream.writeStream.outputMode(mode).format("parquet").option("path", output)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True)
    )
    try:
        for key, value in settings.items():
            conf.set(key, value)
        query = writer.start()  # the stream keeps its own copy of the settings
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)
    query.awaitTermination()
    return query
