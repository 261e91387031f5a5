"""Structured Streaming forms of the state operators.

Event time is ``ts`` cast to TIMESTAMP (watermarks refuse TIMESTAMP_NTZ);
the 10-minute watermark is our choice (the reference defines no late-data
rule). State is Spark's own: grouped aggregates, combined before the shuffle,
so a hot user is no single Python loop. Sinks are replay-safe: file sinks keep
their own commit log, and ``foreachBatch`` writes each batch to a folder named
by its batch id with overwrite, so a replayed batch replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators.intents import confidence_gate, gate_flags, rank_candidates, top_two

WATERMARK = "10 minutes"
SESSION_GAP = "60 minutes"
EVENT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                "value double, props string")


def event_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Events as a stream (file source on a folder or glob), ``ts`` as TIMESTAMP."""
    r = spark.readStream.schema(EVENT_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def stream_sessions(events: DataFrame, gap: str = SESSION_GAP, watermark: str = WATERMARK) -> DataFrame:
    """F7 on a stream: session windows per user, emitted once the
    watermark closes them (append mode)."""
    return (events.withWatermark("ts", watermark)
            .groupBy("user_id", F.session_window("ts", gap).alias("s"))
            .agg(F.count("*").alias("n_events"))
            .select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "n_events"))


def stream_slots(events: DataFrame) -> DataFrame:
    """F5 on a stream (update mode): per (user, slot) the latest write by
    (ts, seq); slot = event_type, ``error`` resets ``click`` (a null value is a
    write like any other). A late, older write changes nothing."""
    et = F.col("event_type")
    writes = events.select(
        "user_id", F.when(et == "error", F.lit("click")).otherwise(et).alias("slot"),
        F.when(et == "error", F.lit(None).cast("string")).otherwise(F.col("value").cast("string")).alias("value"),
        "ts", F.col("event_id").alias("seq"))
    latest = writes.groupBy("user_id", "slot").agg(
        F.max(F.struct("ts", "seq")).alias("at"), F.max_by(F.struct("value"), F.struct("ts", "seq")).alias("last"))
    return latest.select("user_id", "slot", F.col("last.value").alias("value"), "at.ts", "at.seq")


def stream_uttered(events: DataFrame) -> DataFrame:
    """The first utterance per (user, text), remembered for ever (update mode): a
    text said again is not first again, and an older one that comes late takes its place."""
    first = events.groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("f"))
    return first.select("user_id", "event_type", "f.event_id", "f.ts")


def gate_batch(batch: DataFrame) -> DataFrame:
    """C6-C9 over the requests (user, day) of one batch of events (the batch
    form that J4 ends in)."""
    cands = _candidates(batch)
    ranked = rank_candidates(cands, ["user_id", "day"], [F.col("confidence").desc(), F.col("event_id")], top=2)
    return _gate_columns(confidence_gate(top_two(ranked, ["user_id", "day"])))


def _candidates(events: DataFrame) -> DataFrame:
    return events.select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", "ts",
        F.concat(F.lit("faq/"), F.col("event_id").cast("string")).alias("key"),
        (F.get_json_object("props", "$.k").cast("int").cast("double") / F.lit(100.0)).alias("confidence"))


def _gate_columns(gated: DataFrame) -> DataFrame:
    return gate_flags(gated).select(
        "user_id", "day", "outcome", F.col("conf1").alias("bot_confid_to_user_question"),
        "bot_question_confusion", "bot_question_incomprehension")


def stream_feedback(events: DataFrame, path: str, checkpoint: str, watermark: str = WATERMARK):
    """A7 as messages arrive, gate (C8) included, exact across micro-batches.

    A batch's best two candidates per request (user, day) are merged with those of
    the open days so far, kept in ``<path>-state/batch=<id - 1>``, and written as
    ``batch=<id>`` next to the gate of every request the batch touched
    (``path/batch=<id>``). A day is open until the watermark (the latest event time of
    earlier batches less the delay) passes its end; later rows for it are late data
    and ignored, and its candidates leave the state. Every write overwrites its batch
    folder, so a replay is idempotent."""
    spark = events.sparkSession
    state_at = f"{path.rstrip('/')}-state"

    def write(batch: DataFrame, batch_id: int) -> None:
        cands = _candidates(batch)
        seen = None
        if batch_id > 0:
            state = spark.read.parquet(f"{state_at}/batch={batch_id - 1}")
            seen = state.agg(F.max("seen")).first()[0]
        day_end = F.to_timestamp(F.date_add(F.to_date("day"), 1))
        is_open = F.lit(True) if seen is None else day_end > F.lit(seen) - F.expr(f"INTERVAL {watermark}")
        fresh = cands.filter(is_open).select("user_id", "day", "event_id", "key", "confidence")
        both = fresh.withColumn("fresh", F.lit(True))
        if batch_id > 0:
            kept = state.where("user_id is not null").filter(is_open)
            both = both.unionByName(kept.select(*fresh.columns, F.lit(False).alias("fresh")))
        keys = ["user_id", "day"]
        best = rank_candidates(both, keys, [F.col("confidence").desc(), F.col("event_id")], top=2)
        latest = batch.agg(F.greatest(F.max("ts"), F.lit(seen).cast("timestamp")).alias("seen"))
        # the state: candidates, and one row that carries the latest event time
        rows = best.select(*fresh.columns, F.lit(None).cast("timestamp").alias("seen"))
        marker = latest.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fresh.schema], "seen")
        rows.unionByName(marker).write.mode("overwrite").parquet(f"{state_at}/batch={batch_id}")
        touched = fresh.select(*keys).distinct()
        new = spark.read.parquet(f"{state_at}/batch={batch_id}").where("user_id is not null")
        ranked = rank_candidates(new.join(touched, keys, "left_semi"), keys,
                                 [F.col("confidence").desc(), F.col("event_id")], top=2)
        _gate_columns(confidence_gate(top_two(ranked, keys))).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (events.writeStream.foreachBatch(write).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_per_request(table: DataFrame, keys=("user_id", "day")) -> DataFrame:
    """Current rows of an update-mode table written per batch: the row of the
    highest batch id for each key (a grouped ``max_by``)."""
    cols = [c for c in table.columns if c not in (*keys, "batch")]
    latest = table.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("batch")).alias("_r"))
    return latest.select(*keys, *[F.col("_r." + c).alias(c) for c in cols])


def run_to_sink(df: DataFrame, path: str, checkpoint: str, mode: str = "append", fmt: str = "parquet"):
    """Run a streaming query over all available input into a file sink."""
    q = (df.writeStream.format(fmt).outputMode(mode).option("path", path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def run_update_to_table(df: DataFrame, path: str, checkpoint: str):
    """Run an update-mode query; each batch's updated rows are appended to
    ``path/batch=<id>`` (overwrite per batch id, so replays are idempotent)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    q = (df.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
