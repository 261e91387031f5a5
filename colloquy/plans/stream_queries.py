"""Streaming queries (J1-J4): each runs its stream over the ``events``
table folder (glob ``events*.parquet``) to completion with an
``availableNow`` trigger, then reads what the sink committed.

J1 emits the sessions that the watermark closes: those that end 10 minutes or
more before the latest event. J2-J4 end in the state of their batch forms;
``j4_stream_facts`` reads the events as they come in three parts, a third of the time
span each, and ends in the rows of F11 that the watermark lets go.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from colloquy.plans.gate_queries import GATED_SQL
from colloquy.plans import fixtures as X
from colloquy.plans.registry import query
from colloquy.plans.state_queries import FACTS_SQL
from colloquy.session import scratch_path
from colloquy.streaming import streams as J
from colloquy.streaming.facts import FactStream

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _events(spark, sf_dir):
    return J.event_stream(spark, f"{sf_dir}/events*.parquet")


@query("j1_stream_sessions", "J1", """
WITH e AS (SELECT user_id, ts, event_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
m AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 60 MINUTE THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM e),
s AS (SELECT user_id, sid, min(ts) AS s0, max(ts) + INTERVAL 60 MINUTE AS s1, count(*) AS n_events FROM m GROUP BY ALL)
SELECT user_id, strftime(s0, '%Y-%m-%d %H:%M:%S.%f') AS session_start,
  strftime(s1, '%Y-%m-%d %H:%M:%S.%f') AS session_end, n_events
FROM s WHERE s1 <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def j1(spark, sf_dir):
    out, ck = scratch_path(spark, "j1-out"), scratch_path(spark, "j1-ckpt")
    J.run_to_sink(J.stream_sessions(_events(spark, sf_dir)), out, ck)
    s = spark.read.parquet(out)
    return s.select("user_id", F.date_format("session_start", TS_FMT).alias("session_start"),
                    F.date_format("session_end", TS_FMT).alias("session_end"), "n_events")


@query("j2_stream_slots", "J2", """
WITH w AS (SELECT user_id, CASE WHEN event_type = 'error' THEN 'click' ELSE event_type END AS slot,
    CASE WHEN event_type = 'error' THEN NULL ELSE value::VARCHAR END AS value,
    row_number() OVER (PARTITION BY user_id, CASE WHEN event_type = 'error' THEN 'click' ELSE event_type END
                       ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT user_id, slot, value FROM w WHERE rn = 1""")
def j2(spark, sf_dir):
    out, ck = scratch_path(spark, "j2-out"), scratch_path(spark, "j2-ckpt")
    J.run_update_to_table(J.stream_slots(_events(spark, sf_dir)), out, ck)
    emitted = spark.read.parquet(out)
    final = emitted.groupBy("user_id", "slot").agg(
        F.max_by(F.struct("value"), F.struct("ts", "seq")).alias("s"))
    return final.select("user_id", "slot", F.col("s.value").alias("value"))


@query("j3_stream_uttered", "J3", """
WITH r AS (SELECT user_id, event_type, event_id, ts,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM r WHERE rn = 1""")
def j3(spark, sf_dir):
    out, ck = scratch_path(spark, "j3-out"), scratch_path(spark, "j3-ckpt")
    J.run_update_to_table(J.stream_uttered(_events(spark, sf_dir)), out, ck)
    s = J.latest_per_request(spark.read.parquet(out), ("user_id", "event_type"))
    return s.select("user_id", "event_type", "event_id", F.date_format("ts", TS_FMT).alias("ts"))


@query("j4_stream_feedback", "J4", f"""
SELECT user_id, day, outcome, conf1 AS bot_confid_to_user_question,
  (outcome = 'confused')::INTEGER AS bot_question_confusion,
  (outcome = 'not_understood')::INTEGER AS bot_question_incomprehension FROM ({GATED_SQL}) g""")
def j4(spark, sf_dir):
    out, ck = scratch_path(spark, "j4-out"), scratch_path(spark, "j4-ckpt")
    q = J.stream_feedback(_events(spark, sf_dir), out, ck)
    q.awaitTermination()
    return J.latest_per_request(spark.read.parquet(out))


def fact_stream(path: str) -> FactStream:
    """Events as messages, mapped as for F11 (``state_queries``)."""
    et, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("int")
    return FactStream(
        path, ["user_id"], user=F.when(et.isin("click", "signup"), F.col("props")),
        bot=F.when(et == "purchase", F.concat(F.lit("faq/"), F.col("event_id").cast("string"))), opens=et == "view",
        details=F.when(et.isin(list(X.PROFILE_INTENTS)), (et == "view").cast("int")),
        candidate=F.concat(F.lit("faq/"), F.col("event_id").cast("string")), confidence=k.cast("double") / F.lit(100.0),
        intent="intent", note="note_text")


def fact_messages(events):
    et = F.col("event_type")
    return events.withColumns({
        "intent": F.when(et.isin("click", "purchase"), F.lit("number")).when(et == "signup", F.lit("faq"))
        .when(et == "error", F.lit("deny")).otherwise(F.lit("other")),
        "note_text": ((F.get_json_object("props", "$.k").cast("int") % 10) + 1).cast("string")})


@query("j4_stream_facts", "J4", f"""
WITH w AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events),
x AS ({FACTS_SQL})
SELECT x.* EXCLUDE (opened_ts, filled_ts) FROM x, w
WHERE filled_ts < mark AND filled_ts <= opened_ts + INTERVAL 7 DAY AND date_trunc('day', opened_ts) + INTERVAL 1 DAY <= mark""")
def j4_facts(spark, sf_dir):
    source, out, ck = (scratch_path(spark, f"j4f-{x}") for x in ("in", "out", "ckpt"))
    ev = spark.read.schema(J.EVENT_SCHEMA).parquet(f"{sf_dir}/events*.parquet")
    first, last = ev.agg(F.min("ts"), F.max("ts")).first()
    messages = fact_messages(J.event_stream(spark, f"{source}/events*"))
    for i in range(3):  # three parts in the order of time, each of many files and one micro-batch
        third = F.lit(0) if first == last else F.least(F.lit(2), F.floor(
            3 * (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(first).cast("timestamp")))
            / F.lit((last - first) / dt.timedelta(microseconds=1))))
        ev.where(third == i).write.parquet(f"{source}/events{i}")
        fact_stream(out).start(messages, ck).awaitTermination()
    return spark.read.parquet(out).drop("batch").withColumns(
        {c: F.date_format(c, TS_FMT) for c in ("time_user_question", "time_bot_answer")})
