"""Conversation-state queries (F1-F12) over ``conversations`` and ``events``.

Fixture mapping: a conversation is a ``conv_id`` (turn-ordered) or a user's
events (ordered by ts, event_id). A user turn is an FAQ question when its text
holds a comma. Slots: slot = event_type, ``error`` resets ``click``.
Rating form: opens at ``view``; ``click``/``purchase`` are intent ``number``,
``signup`` is ``faq``, ``error`` is ``deny``; the rating text is k % 10 + 1.
Sign-in: ``signup`` issues code k % 5, ``click`` attempts k % 5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.operators import state as S
from colloquy.operators.intents import confidence_gate, gate_flags, top_two
from colloquy.operators.scan import time_chunk, turn_chunk
from colloquy.plans import fixtures as X
from colloquy.plans.registry import query, sql_lit as L
from colloquy.session import materialize

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_SQL = "'%Y-%m-%d %H:%M:%S.%f'"
CONV_KEYS, CONV_ORDER = ["conv_id"], ["turn"]
EV_KEYS, EV_ORDER = ["user_id"], ["ts", "event_id"]
SLOTS = ["click", "view", "purchase", "signup"]

_RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_CONV_W = f"OVER (PARTITION BY conv_id ORDER BY turn {_RUN})"
_EV_W = f"OVER (PARTITION BY user_id ORDER BY ts, event_id {_RUN})"


def _fmt(c):
    return F.date_format(c, TS_FMT)


# ---------------------------------------------------------------- F1-F4
@query("f1_last_user_message", "F1", """
SELECT conv_id, arg_max(text, turn) AS last_text, max(turn) AS last_turn
FROM conversations WHERE role = 'user' GROUP BY conv_id""")
def f1(spark, sf_dir):
    return S.last_message(X.conversations(spark, sf_dir), CONV_KEYS, "turn", "role", "user")


@query("f1_last_user_by_turn", "F1", f"""
SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) {_CONV_W} AS last_user_text
FROM conversations""")
def f1_rows(spark, sf_dir):
    conv = X.conversations(spark, sf_dir)
    out = S.last_value_by_row(conv, CONV_KEYS, CONV_ORDER, F.col("role") == "user", F.col("text"),
                              "last_user_text", chunk=turn_chunk())
    return out.select("conv_id", "turn", "last_user_text")


@query("f2_last_bot_message", "F2", f"""
SELECT conv_id, turn, last_value(CASE WHEN role = 'assistant' THEN text END IGNORE NULLS) {_CONV_W} AS last_bot_text
FROM conversations""")
def f2(spark, sf_dir):
    conv = X.conversations(spark, sf_dir)
    out = S.last_value_by_row(conv, CONV_KEYS, CONV_ORDER, F.col("role") == "assistant", F.col("text"),
                              "last_bot_text", chunk=turn_chunk())
    return out.select("conv_id", "turn", "last_bot_text")


_INTENT_SQL = "CASE WHEN role = 'user' THEN CASE WHEN contains(text, ',') THEN 'faq' ELSE 'chitchat' END END"


@query("f3_last_faq_answer", "F3", f"""
WITH a AS (SELECT conv_id, turn, role, text, last_value({_INTENT_SQL} IGNORE NULLS) {_CONV_W} AS user_intent
           FROM conversations)
SELECT conv_id, turn,
  last_value(CASE WHEN role = 'assistant' AND user_intent = 'faq' THEN text END IGNORE NULLS) {_CONV_W}
    AS last_faq_answer
FROM a""")
def f3(spark, sf_dir):
    conv = X.conversations(spark, sf_dir).withColumn(
        "intent", F.when(F.col("role") == "user",
                         F.when(F.col("text").contains(","), F.lit("faq")).otherwise(F.lit("chitchat"))))
    out = S.last_faq_answer(conv, CONV_KEYS, CONV_ORDER, "role", "intent", chunk=turn_chunk())
    return out.select("conv_id", "turn", "last_faq_answer")


@query("f4_uttered_history", "F4", """
SELECT conv_id, replace(text, chr(160), ' ') AS text, min(turn) AS first_turn
FROM conversations WHERE role = 'assistant' GROUP BY 1, 2""")
def f4(spark, sf_dir):
    bot = X.conversations(spark, sf_dir).filter(F.col("role") == "assistant")
    return S.uttered_history(bot, CONV_KEYS, "turn")


# ---------------------------------------------------------------- F5-F8
_WRITES_SQL = """SELECT user_id, event_id, ts,
    CASE WHEN event_type = 'error' THEN 'click' ELSE event_type END AS slot,
    CASE WHEN event_type = 'error' THEN NULL ELSE value::VARCHAR END AS value FROM events"""


def _writes(spark, sf_dir):
    return X.slot_writes(spark, sf_dir).withColumnRenamed("conv_id", "user_id").withColumnRenamed("seq", "event_id")


@query("f5_fold_slots", "F5", f"""
WITH w AS (SELECT *, row_number() OVER (PARTITION BY user_id, slot ORDER BY ts DESC, event_id DESC) AS rn
           FROM ({_WRITES_SQL}))
SELECT user_id, {", ".join(f"max(CASE WHEN slot = '{s}' AND rn = 1 THEN value END) AS {s}" for s in SLOTS)}
FROM w GROUP BY user_id""")
def f5(spark, sf_dir):
    return S.fold_slots(_writes(spark, sf_dir), EV_KEYS, EV_ORDER, slots=SLOTS)


_PROFILE_INTENT_SQL = """CASE event_type WHEN 'click' THEN 'short_utters' WHEN 'view' THEN 'long_utters'
    WHEN 'purchase' THEN 'dont_care' ELSE event_type END"""


@query("f6_set_profile", "F6", f"""
SELECT event_id,
  CASE WHEN {_PROFILE_INTENT_SQL} IN ('short_utters', 'long_utters', 'dont_care') THEN {_PROFILE_INTENT_SQL} END AS profile,
  CASE {_PROFILE_INTENT_SQL} {" ".join(f"WHEN {L(k)} THEN {L(v)}" for k, v in S.PROFILE_ACK.items())}
    ELSE {L(S.PROFILE_UNKNOWN_ACK)} END AS acknowledgement,
  CASE WHEN {_PROFILE_INTENT_SQL} = 'long_utters' THEN 1 END AS user_wants_details
FROM events""")
def f6(spark, sf_dir):
    ev = X.events(spark, sf_dir, "event_id", "event_type")
    et = F.col("event_type")
    intent = F.coalesce(*[F.when(et == k, F.lit(v)) for k, v in X.PROFILE_INTENTS.items()], et)
    profile, ack, details = S.set_profile(intent)
    return ev.select("event_id", profile.alias("profile"), ack.alias("acknowledgement"),
                     details.alias("user_wants_details"))


def _sessions_sql(minutes: int) -> str:
    return f"""WITH e AS (SELECT user_id, event_id, ts, event_type, value, props,
      lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
    m AS (SELECT *, CASE WHEN prev IS NULL OR ts > prev + INTERVAL {minutes} MINUTE THEN ts END AS mark FROM e)
    SELECT user_id, event_id, ts, event_type, value, props,
      last_value(mark IGNORE NULLS) {_EV_W} AS session_start FROM m"""


def _sessions(spark, sf_dir, minutes: int) -> DataFrame:
    ev = X.events(spark, sf_dir, "user_id", "event_id", "ts", "event_type", "value", "k")
    return S.sessions(ev, EV_KEYS, "ts", "event_id", minutes, chunk=time_chunk())


@query("f7_sessions", "F7", f"""
SELECT user_id, event_id, strftime(session_start, {TS_SQL}) AS session_start FROM ({_sessions_sql(60)})""")
def f7(spark, sf_dir):
    return _sessions(spark, sf_dir, 60).select("user_id", "event_id", _fmt("session_start").alias("session_start"))


@query("f7_session_count_60m", "F7", f"""
SELECT count(DISTINCT (user_id, session_start)) AS n_sessions FROM ({_sessions_sql(60)})""")
def f7_count60(spark, sf_dir):
    return _sessions(spark, sf_dir, 60).select("user_id", "session_start").distinct().agg(
        F.count("*").alias("n_sessions"))


@query("f7_session_count_12h", "F7", f"""
SELECT count(DISTINCT (user_id, session_start)) AS n_sessions FROM ({_sessions_sql(720)})""")
def f7_count12h(spark, sf_dir):
    return _sessions(spark, sf_dir, 720).select("user_id", "session_start").distinct().agg(
        F.count("*").alias("n_sessions"))


def _session_writes(spark, sf_dir):
    s = _sessions(spark, sf_dir, 60)
    et = F.col("event_type")
    # sessionised slot writes feed several branches: computed once
    return materialize(s.select(
        "user_id", "event_id", "ts", "session_start",
        F.when(et == "error", F.lit("click")).otherwise(et).alias("slot"),
        F.when(et == "error", F.lit(None).cast("string")).otherwise(F.col("value").cast("string")).alias("value"),
    ), "session-writes")


_SW_SQL = f"""SELECT user_id, event_id, ts, session_start,
    CASE WHEN event_type = 'error' THEN 'click' ELSE event_type END AS slot,
    CASE WHEN event_type = 'error' THEN NULL ELSE value::VARCHAR END AS value FROM ({_sessions_sql(60)})"""


@query("f8_carry_over_reset", "F8", f"""
WITH w AS (SELECT *, row_number() OVER (PARTITION BY user_id, session_start, slot ORDER BY ts DESC, event_id DESC) AS rn
           FROM ({_SW_SQL}))
SELECT user_id, strftime(session_start, {TS_SQL}) AS session_start, slot, value FROM w WHERE rn = 1""")
def f8_reset(spark, sf_dir):
    out = S.carry_over(_session_writes(spark, sf_dir), EV_KEYS, EV_ORDER, keep=False)
    return out.select("user_id", _fmt("session_start").alias("session_start"), "slot", "value")


@query("f8_carry_over_keep", "F8", f"""
WITH w AS ({_SW_SQL}),
g AS (SELECT DISTINCT s.user_id, s.session_start, k.slot FROM w s JOIN (SELECT DISTINCT user_id, slot FROM w) k USING (user_id)),
j AS (SELECT g.user_id, g.session_start, g.slot, w.value,
        row_number() OVER (PARTITION BY g.user_id, g.session_start, g.slot ORDER BY w.ts DESC, w.event_id DESC) AS rn
      FROM g JOIN w ON w.user_id = g.user_id AND w.slot = g.slot AND w.session_start <= g.session_start)
SELECT user_id, strftime(session_start, {TS_SQL}) AS session_start, slot, value FROM j WHERE rn = 1""")
def f8_keep(spark, sf_dir):
    out = S.carry_over(_session_writes(spark, sf_dir), EV_KEYS, EV_ORDER, keep=True)
    return out.select("user_id", _fmt("session_start").alias("session_start"), "slot", "value")


@query("f8_slot_intervals", "F8", f"""
WITH w AS (SELECT *, row_number() OVER (PARTITION BY user_id, session_start, slot ORDER BY ts DESC, event_id DESC) AS rn
           FROM ({_SW_SQL}))
SELECT user_id, slot, strftime(session_start, {TS_SQL}) AS session_from,
  strftime(lead(session_start) OVER (PARTITION BY user_id, slot ORDER BY session_start), {TS_SQL}) AS session_to, value
FROM w WHERE rn = 1""")
def f8_intervals(spark, sf_dir):
    out = S.slot_intervals(_session_writes(spark, sf_dir), EV_KEYS, EV_ORDER)
    return out.select("user_id", "slot", _fmt("session_from").alias("session_from"),
                      _fmt("session_to").alias("session_to"), "value")


# ---------------------------------------------------------------- F9-F12
_FORM_EVENTS_SQL = """SELECT user_id, event_id, ts, event_type, props,
    CASE WHEN event_type IN ('click', 'purchase') THEN 'number' WHEN event_type = 'signup' THEN 'faq'
         WHEN event_type = 'error' THEN 'deny' ELSE 'other' END AS intent,
    ((json_extract_string(props, '$.k')::INTEGER % 10) + 1)::VARCHAR AS note_text FROM events"""
_FORMS_SQL = f"""WITH e AS ({_FORM_EVENTS_SQL}),
t AS (SELECT *, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) {_EV_W} AS form_id FROM e),
c AS (SELECT user_id, form_id, note_text, ts, event_id,
        row_number() OVER (PARTITION BY user_id, form_id ORDER BY ts, event_id) AS rn
      FROM t WHERE form_id IS NOT NULL AND intent = 'number' AND note_text IN ('1', '2', '3', '4', '5'))
SELECT f.user_id, f.form_id, c.note_text AS note, c.ts AS filled_ts, c.event_id AS filled_event_id
FROM (SELECT user_id, event_id AS form_id FROM e WHERE event_type = 'view') f
LEFT JOIN (SELECT * FROM c WHERE rn = 1) c USING (user_id, form_id)"""


def _form_events(spark, sf_dir):
    ev = X.events(spark, sf_dir, "user_id", "event_id", "ts", "day", "event_type", "props", "k")
    et = F.col("event_type")
    return ev.withColumn(
        "intent", F.when(et.isin("click", "purchase"), F.lit("number")).when(et == "signup", F.lit("faq"))
        .when(et == "error", F.lit("deny")).otherwise(F.lit("other"))
    ).withColumn("note_text", ((F.col("k") % 10) + 1).cast("string"))


def _forms(spark, sf_dir):
    ev = _form_events(spark, sf_dir)
    return S.form_fill(ev, EV_KEYS, EV_ORDER, F.col("event_type") == "view", "intent", "note_text",
                       F.col("event_id"), chunk=time_chunk())


@query("f9_form_fill", "F9", f"""
SELECT user_id, form_id, note, strftime(filled_ts, {TS_SQL}) AS filled_ts, filled_event_id FROM ({_FORMS_SQL})""")
def f9(spark, sf_dir):
    return _forms(spark, sf_dir).select("user_id", "form_id", "note", _fmt("filled_ts").alias("filled_ts"),
                                        "filled_event_id")


_AUTH_SQL = f"""WITH e AS (SELECT user_id, event_id, ts, event_type,
      json_extract_string(props, '$.k')::INTEGER % 5 AS code FROM events),
t AS (SELECT *, last_value(CASE WHEN event_type = 'signup' THEN code END IGNORE NULLS) {_EV_W} AS issued FROM e)
SELECT user_id, event_id, event_type,
  CASE WHEN issued IS NULL THEN 'no_code' WHEN code = issued THEN 'success' ELSE 'retry' END AS outcome FROM t"""


def _auth(spark, sf_dir):
    ev = X.events(spark, sf_dir, "user_id", "event_id", "ts", "event_type", "k").withColumn("code", F.col("k") % 5)
    return S.auth_outcomes(ev, EV_KEYS, EV_ORDER, F.col("event_type") == "signup",
                           F.col("event_type") == "click", F.col("code"), chunk=time_chunk())


@query("f10_auth_outcomes", "F10", f"""
SELECT user_id, event_id, outcome, CASE outcome {" ".join(f"WHEN {L(k)} THEN {L(v)}" for k, v in S.AUTH_NEXT_STEP.items())} END
  AS next_step FROM ({_AUTH_SQL}) a WHERE event_type = 'click'""")
def f10(spark, sf_dir):
    return _auth(spark, sf_dir).select("user_id", "event_id", "outcome", "next_step")


@query("f10_auth_funnel", "F10", f"""
SELECT user_id, count(*) FILTER (WHERE event_type = 'signup') AS n_codes,
  count(*) FILTER (WHERE event_type = 'click') AS n_attempts,
  count(*) FILTER (WHERE event_type = 'click' AND outcome = 'success') AS n_success,
  count(*) FILTER (WHERE event_type = 'click' AND outcome = 'success') > 0 AS authenticated
FROM ({_AUTH_SQL}) a GROUP BY user_id
HAVING count(*) FILTER (WHERE event_type IN ('signup', 'click')) > 0""")
def f10_funnel(spark, sf_dir):
    ev = X.events(spark, sf_dir, "user_id", "event_type")
    return S.auth_funnel(_auth(spark, sf_dir), ev.filter(F.col("event_type") == "signup"), EV_KEYS)


# clicks and signups are user texts (their props), purchases bot texts (their
# key), views open the rating form; the profile event before it gives the details
# flag, the gate of the request (user, day) the rest. Times are written as text so
# that both engines compare them alike; the operator itself returns TIMESTAMPs.
FACT_COLUMNS = ["pseudo", "question_id", "user_question", "bot_answer", "bot_confid_to_user_question",
                "user_note", "time_user_question", "time_bot_answer", "bot_question_confusion",
                "bot_question_incomprehension", "user_wants_details"]

_BEFORE = "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
FACTS_SQL = f"""
WITH forms AS ({_FORMS_SQL}),
e AS (SELECT user_id, event_id, ts, strftime(ts, '%Y-%m-%d') AS day,
        last_value(CASE WHEN event_type IN ('click', 'signup') THEN props END IGNORE NULLS) {_BEFORE} AS question,
        last_value(CASE WHEN event_type IN ('click', 'signup') THEN ts END IGNORE NULLS) {_BEFORE} AS question_ts,
        last_value(CASE WHEN event_type = 'purchase' THEN 'faq/' || event_id::VARCHAR END IGNORE NULLS) {_BEFORE} AS answer,
        last_value(CASE WHEN event_type = 'purchase' THEN ts END IGNORE NULLS) {_BEFORE} AS answer_ts,
        last_value(CASE WHEN event_type IN ('click', 'view', 'purchase') THEN event_type END IGNORE NULLS) {_BEFORE}
          AS prev_profile
      FROM events),
r AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_id, 'faq/' || event_id::VARCHAR AS key,
        json_extract_string(props, '$.k')::INTEGER / 100.0::DOUBLE AS confidence,
        row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d')
          ORDER BY json_extract_string(props, '$.k')::INTEGER DESC, event_id) AS rk FROM events),
t AS (SELECT user_id, day, count(*) AS n_ranked,
        max(CASE WHEN rk = 1 THEN key END) AS key1, max(CASE WHEN rk = 1 THEN confidence END) AS conf1,
        max(CASE WHEN rk = 2 THEN confidence END) AS conf2 FROM r WHERE rk <= 2 GROUP BY user_id, day),
g AS (SELECT *, CASE WHEN n_ranked <= 1 THEN 'no_ranking' WHEN conf1 < 0.4::DOUBLE THEN 'not_understood'
        WHEN conf1 - conf2 < 0.2::DOUBLE THEN 'confused' ELSE 'answer' END AS outcome FROM t)
SELECT 'user' || f.user_id::VARCHAR AS pseudo, split_part(g.key1, '/', 2)::INTEGER AS question_id,
  e.question AS user_question, e.answer AS bot_answer, g.conf1 AS bot_confid_to_user_question,
  f.note::INTEGER AS user_note, strftime(e.question_ts, {TS_SQL}) AS time_user_question,
  strftime(e.answer_ts, {TS_SQL}) AS time_bot_answer,
  (g.outcome = 'confused')::INTEGER AS bot_question_confusion,
  (g.outcome = 'not_understood')::INTEGER AS bot_question_incomprehension,
  CASE WHEN e.prev_profile = 'view' THEN 1 ELSE 0 END AS user_wants_details, e.ts AS opened_ts, f.filled_ts
FROM forms f JOIN e ON e.user_id = f.user_id AND e.event_id = f.form_id
JOIN g ON g.user_id = f.user_id AND g.day = e.day
WHERE f.note IS NOT NULL"""


def facts(spark, sf_dir) -> DataFrame:
    et = F.col("event_type")
    gate = gate_flags(confidence_gate(top_two(X.ranking_rows(spark, sf_dir), ["user_id", "day"])))
    out = S.interaction_facts(
        _form_events(spark, sf_dir), gate, EV_KEYS, EV_ORDER,
        user=F.when(et.isin("click", "signup"), F.col("props")),
        bot=F.when(et == "purchase", F.concat(F.lit("faq/"), F.col("event_id").cast("string"))),
        opens=et == "view", details=F.when(et.isin(list(X.PROFILE_INTENTS)), (et == "view").cast("int")),
        intent="intent", note="note_text", form_id=F.col("event_id"), time="ts", request=["user_id", "day"],
        chunk=time_chunk())
    return out.withColumns({c: _fmt(c) for c in ("time_user_question", "time_bot_answer")})


@query("f11_interaction_facts", "F11", f"SELECT * EXCLUDE (opened_ts, filled_ts) FROM ({FACTS_SQL})")
def f11(spark, sf_dir):
    return facts(spark, sf_dir)


@query("f12_rating_notice", "F12", f"""
SELECT user_id, form_id, {L(S.RATING_NOTICE.split("{note}")[0])} || note || {L(S.RATING_NOTICE.split("{note}")[1])}
  AS notice FROM ({_FORMS_SQL}) WHERE note IS NOT NULL""")
def f12(spark, sf_dir):
    forms = _forms(spark, sf_dir).filter(F.col("note").isNotNull())
    return forms.select("user_id", "form_id", S.rating_notice(F.col("note")).alias("notice"))
