"""Batch and stream forms agree; late events and replays are handled."""

import datetime as dt

from pyspark.sql import functions as F

from colloquy.session import scratch_path
from colloquy.streaming import streams as J

SF = "/root/testdata/sf0.001"


def test_j1_sessions_match_batch(spark):
    out, ck = scratch_path(spark, "t-j1"), scratch_path(spark, "t-j1c")
    J.run_to_sink(J.stream_sessions(J.event_stream(spark, f"{SF}/events*.parquet")), out, ck)
    streamed = {tuple(r) for r in spark.read.parquet(out).collect()}
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    batch = (ev.groupBy("user_id", F.session_window("ts", J.SESSION_GAP).alias("s")).agg(F.count("*").alias("n"))
             .select("user_id", "s.start", "s.end", "n"))
    closed = ev.agg(F.max("ts") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    batch_rows = {tuple(r) for r in batch.where(F.col("end") <= F.lit(closed)).collect()}
    assert streamed and streamed == batch_rows


def test_j3_first_for_ever_and_late_firsts(spark):
    base = scratch_path(spark, "t-j3in")
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    _write(spark, [(2, t0, 7, "view", 1.0, "{}")], f"{base}/events1")
    _write(spark, [(3, t0 + dt.timedelta(days=3), 7, "view", 1.0, "{}")], f"{base}/events2")   # said again
    _write(spark, [(1, t0 - dt.timedelta(days=1), 7, "view", 1.0, "{}")], f"{base}/events3")   # an older one, late
    out, ck = scratch_path(spark, "t-j3"), scratch_path(spark, "t-j3c")
    J.run_update_to_table(J.stream_uttered(J.event_stream(spark, f"{base}/events*", max_files=1)), out, ck)
    got = J.latest_per_request(spark.read.parquet(out), ("user_id", "event_type")).collect()
    assert [(r["user_id"], r["event_type"], r["event_id"]) for r in got] == [(7, "view", 1)]


def test_j4_equals_batch_over_many_files(spark):
    base = scratch_path(spark, "t-j4many")
    ev = spark.read.parquet(f"{SF}/events.parquet").orderBy("ts").collect()
    for i in range(5):
        _write(spark, [tuple(r) for r in ev[i * 200:(i + 1) * 200]], f"{base}/events{i}")
    out, ck = scratch_path(spark, "t-j4"), scratch_path(spark, "t-j4c")
    J.stream_feedback(J.event_stream(spark, f"{base}/events*", max_files=1), out, ck).awaitTermination()
    batch = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    want = J.gate_batch(batch)
    got = J.latest_per_request(spark.read.parquet(out)).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def _write(spark, rows, path):
    spark.createDataFrame(rows, J.EVENT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def test_j2_late_write_does_not_override(spark):
    base = scratch_path(spark, "t-j2in")
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    _write(spark, [(1, t0 + dt.timedelta(minutes=5), 7, "view", 3.0, '{"k": 1}')], f"{base}/events1")
    _write(spark, [(2, t0, 7, "view", 9.0, '{"k": 2}')], f"{base}/events2")  # older, arrives later
    out, ck = scratch_path(spark, "t-j2"), scratch_path(spark, "t-j2c")
    J.run_update_to_table(J.stream_slots(J.event_stream(spark, f"{base}/events*", max_files=1)), out, ck)
    emitted = spark.read.parquet(out)
    final = emitted.groupBy("user_id", "slot").agg(F.max_by("value", F.struct("ts", "seq")).alias("v")).first()
    assert final["v"] == "3.0"


def test_j4_replay_is_idempotent(spark):
    out = scratch_path(spark, "t-j4")
    batch = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    for _ in range(2):  # the same batch id written twice
        J.gate_batch(batch).write.mode("overwrite").parquet(f"{out}/batch=0")
    n = spark.read.parquet(out).count()
    assert n == J.gate_batch(batch).count()


def test_j4_gate_exact_across_batches(spark):
    base = scratch_path(spark, "t-j4in")
    t0 = dt.datetime(2024, 1, 1, 9, 0)
    # one request (user 5, that day): best 0.9 in the first file, 0.8 in the second
    _write(spark, [(1, t0, 5, "view", 1.0, '{"k": 90}'), (2, t0, 6, "view", 1.0, '{"k": 50}')], f"{base}/events1")
    _write(spark, [(3, t0 + dt.timedelta(minutes=1), 5, "click", 1.0, '{"k": 80}')], f"{base}/events2")
    out, ck = scratch_path(spark, "t-j4"), scratch_path(spark, "t-j4c")
    J.stream_feedback(J.event_stream(spark, f"{base}/events*", max_files=1), out, ck).awaitTermination()
    got = {r["user_id"]: r["outcome"] for r in J.latest_per_request(spark.read.parquet(out)).collect()}
    assert got == {5: "confused", 6: "no_ranking"}


def test_j4_late_event_for_a_closed_day_is_ignored(spark):
    base = scratch_path(spark, "t-j4late")
    t0 = dt.datetime(2024, 1, 1, 9, 0)
    _write(spark, [(1, t0, 1, "view", 1.0, '{"k": 90}'), (2, t0, 1, "view", 1.0, '{"k": 10}'),
                   (3, t0 + dt.timedelta(days=1, hours=3), 1, "view", 1.0, '{"k": 50}')], f"{base}/events1")
    # day 2024-01-01 is closed (the watermark is past its end): this late event is dropped
    _write(spark, [(4, t0 + dt.timedelta(hours=1), 1, "view", 1.0, '{"k": 95}')], f"{base}/events2")
    out, ck = scratch_path(spark, "t-j4l"), scratch_path(spark, "t-j4lc")
    J.stream_feedback(J.event_stream(spark, f"{base}/events*", max_files=1), out, ck).awaitTermination()
    got = {r["day"]: (r["outcome"], r["bot_confid_to_user_question"])
           for r in J.latest_per_request(spark.read.parquet(out)).collect()}
    assert got["2024-01-01"] == ("answer", 0.9)


def test_j2_state_survives_a_restart(spark):
    base = scratch_path(spark, "t-j2r")
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    out, ck = scratch_path(spark, "t-j2ro"), scratch_path(spark, "t-j2rc")
    _write(spark, [(1, t0, 7, "view", 3.0, '{"k": 1}'), (2, t0, 7, "click", 1.0, '{"k": 1}')], f"{base}/events1")
    J.run_update_to_table(J.stream_slots(J.event_stream(spark, f"{base}/events*")), out, ck)
    # restart on the same checkpoint after new data arrived: only the new file is read,
    # the older click write is reset by the error from the restored state's point of view
    _write(spark, [(3, t0 + dt.timedelta(minutes=1), 7, "error", 0.0, '{"k": 1}')], f"{base}/events2")
    J.run_update_to_table(J.stream_slots(J.event_stream(spark, f"{base}/events*")), out, ck)
    emitted = spark.read.parquet(out)
    assert emitted.select("batch").distinct().count() == 2
    final = {r["slot"]: r["v"] for r in emitted.groupBy("slot").agg(
        F.max_by("value", F.struct("ts", "seq")).alias("v")).collect()}
    assert final == {"view": "3.0", "click": None}
