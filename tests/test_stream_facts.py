"""Rated interactions on a stream: equal to the batch form however messages fall into
batches, each row once, late and expired ratings, replays."""

import datetime as dt

from pyspark.sql import functions as F

from colloquy.plans.stream_queries import fact_messages, fact_stream
from colloquy.session import scratch_path
from colloquy.streaming import streams as J
from colloquy.streaming.facts import FactStream

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1, 9, 0)


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def batch_of(spark, rows):
    return fact_messages(spark.createDataFrame(rows, J.EVENT_SCHEMA).withColumn("ts", F.col("ts").cast("timestamp")))


def event(i, minutes, kind, k=0, user=7):
    return (i, T0 + dt.timedelta(minutes=minutes), user, kind, 1.0, f'{{"k": {k}}}')


def feed(spark, path, batches, **more):
    """The facts of each batch: lists of (pseudo, note)."""
    stream = fact_stream(path)
    for name, value in more.items():
        setattr(stream, name, value)
    out = []
    for i, rows in enumerate(batches):
        stream.batch(batch_of(spark, rows), i)
        got = spark.read.parquet(f"{path}/batch={i}").collect()
        out.append(sorted((r["pseudo"], r["user_note"]) for r in got))
    return out


DAY = 24 * 60
END = event(99, 40 * DAY, "error", user=1)  # moves the watermark past everything


def test_many_small_files_equal_one_batch_and_the_batch_form(spark):
    events = sorted(spark.read.parquet(f"{SF}/events.parquet").collect(), key=lambda r: r["ts"])
    last = events[-1]["ts"]
    rows = [tuple(r) for r in events] + [(10**9, last + dt.timedelta(days=40), 10**6, "error", 0.0, '{"k": 0}')]
    base, out, ck = (scratch_path(spark, f"t-facts-{x}") for x in ("in", "out", "ck"))
    step = len(rows) // 6 + 1
    for i in range(6):
        # within a file in any order, and the last five minutes of a file come with the next one
        spark.createDataFrame(rows[i * step:(i + 1) * step][::-1], J.EVENT_SCHEMA).coalesce(1).write.parquet(f"{base}/events{i}")
    stream = fact_stream(out)
    stream.start(fact_messages(J.event_stream(spark, f"{base}/events*", max_files=1)), ck).awaitTermination()
    many = spark.read.parquet(out).drop("batch")
    once = scratch_path(spark, "t-facts-once")
    fact_stream(once).batch(batch_of(spark, rows), 0)
    assert rows_of(many) == rows_of(spark.read.parquet(once).drop("batch"))

    from colloquy.plans.state_queries import facts
    batch = facts(spark, SF)
    assert many.count() == batch.count() > 0  # no form of these data expires
    assert rows_of(many.select("pseudo", "question_id", "user_note", "user_question", "bot_answer", "user_wants_details")) == \
        rows_of(batch.select("pseudo", "question_id", "user_note", "user_question", "bot_answer", "user_wants_details"))


def test_a_row_leaves_once_when_rated_and_the_day_is_over(spark):
    got = feed(spark, scratch_path(spark, "t-facts"), [
        [event(1, 0, "click", 90), event(2, 1, "view"), event(3, 60, "error")],   # the form opens
        [event(4, 90, "click", 2), event(5, 150, "error")],                       # rated 3
        [event(6, 160, "click", 4), event(7, 200, "error")],                      # a second rating changes nothing
        [event(8, DAY, "error")], [END], [event(100, 41 * DAY, "error", user=1)]])
    assert got == [[], [], [], [("user7", 3)], [], []]


def test_rating_after_midnight_uses_the_gate_of_the_request_day(spark):
    path = scratch_path(spark, "t-facts")
    got = feed(spark, path, [
        [event(1, 0, "click", 90), event(2, 1, "view", 20)], [event(3, DAY + 60, "error", 50)],
        [event(4, 2 * DAY, "click", 1)], [event(5, 5 * DAY, "error")], [END]])
    assert got == [[], [], [], [("user7", 2)], []]
    row = spark.read.parquet(f"{path}/batch=3").first()
    assert row["question_id"] == 1 and row["bot_confid_to_user_question"] == 0.9


def test_late_and_expired_ratings_do_not_count(spark):
    opened = [event(1, 0, "click", 90), event(2, 1, "view"), event(3, 300, "error", user=1)]
    late = feed(spark, scratch_path(spark, "t-facts"), [opened, [event(4, 60, "click", 2)], [event(5, 400, "click", 3)], [END]])
    assert late == [[], [], [], [("user7", 4)]]
    expired = feed(spark, scratch_path(spark, "t-facts"), [opened, [event(4, 8 * DAY, "click", 2)], [END]])
    assert expired == [[], [], []]
    kept = feed(spark, scratch_path(spark, "t-facts"), [opened, [event(4, 8 * DAY, "click", 2)], [END]],
                ttl=F.expr("INTERVAL 9 days"))
    assert kept == [[], [], [("user7", 3)]]


def test_next_form_takes_over_and_waiting_messages_are_put_in_order(spark):
    got = feed(spark, scratch_path(spark, "t-facts"), [
        [event(5, 8, "click", 1), event(1, 0, "click", 50)],      # rating comes before its form
        [event(3, 5, "view"), event(2, 2, "view")],
        [END]])
    assert got == [[], [], [("user7", 2)]]  # only the second form is rated


def test_a_replayed_batch_repeats_itself(spark):
    path = scratch_path(spark, "t-facts")
    batches = [[event(1, 0, "click", 90), event(2, 1, "view")], [event(4, 90, "click", 2)], [END]]
    want = feed(spark, path, batches)
    stream = fact_stream(path)
    for _ in range(2):
        stream.batch(batch_of(spark, batches[2]), 2)
    assert want[2] == [("user7", 3)] and spark.read.parquet(path).count() == 1


def test_null_users_null_times_and_empty_batches(spark):
    rows = [event(1, 0, "click", 90, user=None), event(2, 1, "view", user=None), event(3, 2, "click", 1, user=None),
            (9, None, 7, "view", 1.0, None)]
    got = feed(spark, scratch_path(spark, "t-facts"), [[], rows, [], [END]])
    assert got == [[], [], [], [(None, 2)]]


def test_only_two_states_are_kept(spark):
    path = scratch_path(spark, "t-facts")
    feed(spark, path, [[event(i, i * 60, "click", 1)] for i in range(4)])
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}-state")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert sorted(x.getPath().getName() for x in fs.listStatus(at)) == ["batch=2", "batch=3"]


def test_any_key_and_columns(spark):
    rows = [("a", 1, T0, 1, "q?", None, False, None, "x", "0", "faq/1", 0.9),
            ("a", 1, T0 + dt.timedelta(minutes=1), 2, None, "an answer", False, 1, "x", "0", "faq/2", 0.1),
            ("a", 1, T0 + dt.timedelta(minutes=2), 3, None, None, True, None, "x", "0", None, None),
            ("a", 1, T0 + dt.timedelta(minutes=3), 4, None, None, None, None, "number", "5", None, None),
            ("b", 1, T0 + dt.timedelta(days=3), 5, None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "room string, seat int, ts timestamp, event_id int, u string, b string, o boolean, "
                                     "d int, intent string, note string, k string, c double")
    path = scratch_path(spark, "t-facts")
    FactStream(path, ["room", "seat"], user=F.col("u"), bot=F.col("b"), opens=F.col("o"), details=F.col("d"),
               candidate=F.col("k"), confidence=F.col("c"), intent="intent", note="note").batch(df, 0)
    r = spark.read.parquet(path).first()
    assert (r["pseudo"], r["question_id"], r["user_question"], r["bot_answer"], r["user_note"], r["user_wants_details"]) == \
        ("usera1", 1, "q?", "an answer", 5, 1)
