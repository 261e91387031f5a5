"""Rated interactions as a stream: the eleven columns of F11, each row once.

Messages of a user carry question and answer texts, form openings, ratings and ranked
candidates, in one stream. Event time rules: the watermark is the latest time seen less
``delay``; a message older than the watermark of the batches before it is late and is
ignored; the others wait until the watermark has passed them and are then taken in the
order (time, id), so that the result does not depend on how messages fall into batches.

An opened form remembers the latest question, answer and details flag before it. Its first
valid rating before the next opening fills it; a form that is still open ``ttl`` after its
opening expires. The row leaves in the first batch in which the form is filled and the day
of its request is over (the watermark has passed its end), because only then is the gate
(C8) of that day final.

State is kept as tables, one folder per batch id: messages that wait, the latest texts and
the open form of each user, filled forms that wait for their day, and the best two
candidates of the requests that are open or that an open or filled form refers to. A batch
reads the folder of the batch before and writes its own with overwrite, so a replayed batch
repeats itself; of older folders, two are kept. All steps are grouped aggregates, joins and
the chunked running pass: no user is a loop of its own.

A null key is a user as any other. Rows of one (time, id) are equal messages and count once
for ratings. With a null time a message is ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators.intents import confidence_gate, gate_flags, rank_candidates, top_two
from colloquy.operators.scan import running, time_chunk
from colloquy.operators.state import fact_columns, rating_given, stamped
from colloquy.streaming.streams import WATERMARK

FORM_TTL = "7 days"
KEPT_STATES = 2

TEXT = "struct<text: string, time: timestamp>"
FORM = f"struct<id: bigint, at: timestamp, day: date, q: {TEXT}, a: {TEXT}, d: int>"


class FactStream:
    """Turns messages into facts.

    ``keys`` name the user. The other arguments are columns of a message: ``user`` and
    ``bot`` texts (null elsewhere), ``opens`` whether it opens a form, ``details`` 0/1 or
    null, ``candidate`` and ``confidence`` of the ranked answer, and the names of the
    ``intent`` and ``note`` columns. Messages have a timestamp ``ts`` and a long
    ``event_id``."""

    def __init__(self, path: str, keys: Sequence[str], *, user: Column, bot: Column, opens: Column, details: Column,
                 candidate: Column, confidence: Column, intent: str, note: str, delay: str = WATERMARK,
                 ttl: str = FORM_TTL):
        self.path, self.state, self.keys = path.rstrip("/"), f"{path.rstrip('/')}-state", list(keys)
        self.delay, self.ttl = F.expr(f"INTERVAL {delay}"), F.expr(f"INTERVAL {ttl}")
        self.message = {
            "who": F.struct(*self.keys), "ts": F.col("ts"), "event_id": F.col("event_id").cast("long"),
            "q": stamped(user, "ts").cast(TEXT), "a": stamped(bot, "ts").cast(TEXT), "d": details.cast("int"),
            "opens": F.coalesce(opens, F.lit(False)), "rates": F.coalesce(rating_given(intent, note), F.lit(False)),
            "note": F.col(note).cast("string"), "key": candidate.cast("string"), "confidence": confidence.cast("double")}

    # --- tables of a batch ---------------------------------------------------

    def _at(self, name: str, batch_id: int) -> str:
        return f"{self.state}/batch={batch_id}/{name}"

    def _save(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        df.write.mode("overwrite").parquet(self._at(name, batch_id))
        return df.sparkSession.read.parquet(self._at(name, batch_id))

    def _load(self, spark: SparkSession, name: str, batch_id: int, empty: DataFrame) -> DataFrame:
        return spark.read.parquet(self._at(name, batch_id)) if batch_id >= 0 else empty

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        if batch_id >= 0:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.state}/batch={batch_id}")
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    # --- one batch -----------------------------------------------------------

    def batch(self, events: DataFrame, batch_id: int) -> None:
        """Take one micro-batch in; may be called again with the same id."""
        spark, before = events.sparkSession, batch_id - 1
        fresh = events.where("ts is not null").select(*[c.alias(n) for n, c in self.message.items()])
        key_type = fresh.schema["who"].dataType.simpleString()
        seen = spark.read.parquet(self._at("seen", before)).first()[0] if before >= 0 else None
        if seen is not None:
            fresh = fresh.where(F.col("ts") >= F.lit(seen) - self.delay)  # the others are late
        waiting = self._load(spark, "waiting", before, fresh.limit(0))
        at_hand = self._save(waiting.unionByName(fresh), "messages", batch_id)
        newest = at_hand.agg(F.greatest(F.max("ts"), F.lit(seen).cast("timestamp")).alias("seen"))
        mark = F.lit(self._save(newest, "seen", batch_id).first()[0]).cast("timestamp") - self.delay
        past = F.coalesce(F.col("ts") < mark, F.lit(False))
        self._save(at_hand.where(~past), "waiting", batch_id)
        ready = at_hand.where(past)

        users = self._load(spark, "users", before, spark.createDataFrame(
            [], f"who {key_type}, q {TEXT}, a {TEXT}, d int, form {FORM}"))
        filled = self._load(spark, "filled", before, spark.createDataFrame([], f"who {key_type}, form {FORM}, note string"))
        ranked = self._load(spark, "ranked", before, spark.createDataFrame(
            [], f"who {key_type}, day date, event_id long, key string, confidence double"))

        stepped = self._save(self._step(ready, users), "stepped", batch_id)
        rated = self._rated(stepped, users)
        filled = self._save(filled.unionByName(rated), "all_filled", batch_id)
        users = self._save(self._latest(stepped, users, rated, mark), "users", batch_id)
        cands = ready.where("key is not null").select("who", F.to_date("ts").alias("day"), "event_id", "key", "confidence")
        best = rank_candidates(ranked.unionByName(cands), ["who", "day"], self._order(), top=2)
        ranked = self._save(best.select(*ranked.columns), "all_ranked", batch_id)

        over = self._over(F.col("form.day"), mark)
        gate = gate_flags(confidence_gate(top_two(
            rank_candidates(ranked, ["who", "day"], self._order(), top=2), ["who", "day"])))
        facts = filled.where(over).select("who", F.col("form.day").alias("day"), F.col("form.q").alias("_q"),
                                          F.col("form.a").alias("_a"), F.col("form.d").alias("_d"), "note")
        done = fact_columns(facts.join(gate, ["who", "day"]).select(F.col("who.*"), "*"), self.keys)
        done.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        filled = self._save(filled.where(~over), "filled", batch_id)
        # candidates stay as long as their day is open or a form refers to it
        needed = users.where("form is not null").select("who", "form.day").unionByName(
            filled.select("who", "form.day")).distinct().withColumn("needed", F.lit(True))
        self._save(ranked.join(needed, ["who", "day"], "left").where(
            ~self._over(F.col("day"), mark) | F.col("needed")).select(*ranked.columns), "ranked", batch_id)
        self._forget(spark, batch_id - KEPT_STATES)

    @staticmethod
    def _order() -> list[Column]:
        return [F.col("confidence").desc(), F.col("event_id")]

    @staticmethod
    def _over(day: Column, mark: Column) -> Column:
        return F.coalesce(F.date_add(day, 1).cast("timestamp") <= mark, F.lit(False))

    @staticmethod
    def _step(ready: DataFrame, users: DataFrame) -> DataFrame:
        """Each message with the latest values before it (``q0``, ``a0``, ``d0``, null if none in
        this batch) and the form it opens or falls under (null if none was opened in this batch)."""
        own = F.when(F.col("opens"), F.struct(F.col("event_id").alias("id"), F.col("ts").alias("at")))
        rows = running(ready.withColumn("own", own), ["who"], ["ts", "event_id"],
                       {"q0": F.col("q"), "a0": F.col("a"), "d0": F.col("d"), "under": F.col("own")},
                       inclusive=False, chunk=time_chunk())
        seed = users.select("who", F.col("q").alias("_q"), F.col("a").alias("_a"), F.col("d").alias("_d"))
        rows = rows.join(seed, "who", "left").withColumns({
            "q0": F.coalesce("q0", "_q"), "a0": F.coalesce("a0", "_a"), "d0": F.coalesce("d0", "_d")})
        form = F.struct(F.col("own.id").alias("id"), F.col("own.at").alias("at"), F.to_date("ts").alias("day"),
                        F.col("q0").alias("q"), F.col("a0").alias("a"), F.col("d0").alias("d")).cast(FORM)
        return rows.select("who", "ts", "event_id", "q", "a", "d", "rates", "note", F.when(F.col("opens"), form).alias("form"),
                           F.coalesce("own.id", "under.id").alias("form_id"))

    def _rated(self, stepped: DataFrame, users: DataFrame) -> DataFrame:
        """Forms filled in this batch with their first rating: (who, form, note)."""
        opened = stepped.where("form is not null").select("who", "form").unionByName(
            users.where("form is not null").select("who", "form"))
        ratings = stepped.where("rates").join(
            users.where("form is not null").select("who", F.col("form.id").alias("_open")), "who", "left")
        first = ratings.withColumn("form_id", F.coalesce("form_id", "_open")).where("form_id is not null").groupBy(
            "who", "form_id").agg(F.min(F.struct("ts", "event_id", "note")).alias("r"))
        return opened.withColumn("form_id", F.col("form.id")).join(first, ["who", "form_id"]).where(
            F.col("r.ts") <= F.col("form.at") + self.ttl).select("who", "form", F.col("r.note").alias("note"))

    def _latest(self, stepped: DataFrame, users: DataFrame, rated: DataFrame, mark: Column) -> DataFrame:
        """Per user the latest texts and flag, and the last form if it is neither filled nor expired."""
        at = F.struct("ts", "event_id")

        def last(c):
            return F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_{c}")

        now = stepped.groupBy("who").agg(last("q"), last("a"), last("d"), last("form"))
        both = users.join(now, "who", "full").select(
            "who", *[F.coalesce(f"_{c}", c).alias(c) for c in ("q", "a", "d", "form")])
        gone = rated.select("who", F.col("form.id").alias("_id"), F.lit(True).alias("_gone"))
        open_form = F.col("_gone").isNull() & F.coalesce(F.col("form.at") + self.ttl >= mark, F.lit(False))
        return both.join(gone, (both["who"] == gone["who"]) & (both["form.id"] == gone["_id"]), "left").select(
            both["who"], "q", "a", "d", F.when(open_form, F.col("form")).alias("form"))

    # --- the stream ----------------------------------------------------------

    def start(self, events: DataFrame, checkpoint: str):
        """Run over all available input; facts land in ``path/batch=<id>``."""
        return (events.writeStream.foreachBatch(self.batch).outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
