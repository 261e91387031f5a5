"""Confidence-gate queries (C6-C12) over the ranking derived from ``events``:
request = (user_id, day), candidate ``faq/<event_id>`` with confidence k/100."""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.operators import intents as C
from colloquy.plans import fixtures as X
from colloquy.plans.registry import query

KEYS = ["user_id", "day"]

RANK_SQL = """SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_id, 'faq/' || event_id::VARCHAR AS key,
    json_extract_string(props, '$.k')::INTEGER / 100.0::DOUBLE AS confidence,
    row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d')
      ORDER BY json_extract_string(props, '$.k')::INTEGER DESC, event_id) AS rk
  FROM events"""
TOP2_SQL = f"""SELECT user_id, day, count(*) AS n_ranked,
    max(CASE WHEN rk = 1 THEN key END) AS key1, max(CASE WHEN rk = 1 THEN confidence END) AS conf1,
    max(CASE WHEN rk = 2 THEN key END) AS key2, max(CASE WHEN rk = 2 THEN confidence END) AS conf2
  FROM ({RANK_SQL}) r WHERE rk <= 2 GROUP BY user_id, day"""
OUTCOME_SQL = """CASE WHEN n_ranked <= 1 THEN 'no_ranking'
    WHEN conf1 < 0.4::DOUBLE THEN 'not_understood'
    WHEN conf1 - conf2 < 0.2::DOUBLE THEN 'confused' ELSE 'answer' END"""
GATED_SQL = f"SELECT *, {OUTCOME_SQL} AS outcome FROM ({TOP2_SQL}) t"


def gated(spark, sf_dir):
    return C.confidence_gate(C.top_two(X.ranking_rows(spark, sf_dir), KEYS))


@query("c6_top_confidence", "C6", f"SELECT user_id, day, conf1 AS top_confidence FROM ({TOP2_SQL}) t")
def c6(spark, sf_dir):
    top = C.top_two(X.ranking_rows(spark, sf_dir), KEYS)
    return top.select(*KEYS, C.top_confidence(top).alias("top_confidence"))


@query("c7_confidence_margin", "C7", f"SELECT user_id, day, round(conf1 - conf2, 6) AS margin FROM ({TOP2_SQL}) t")
def c7(spark, sf_dir):
    top = C.top_two(X.ranking_rows(spark, sf_dir), KEYS)
    return top.select(*KEYS, F.round(C.confidence_margin(top), 6).alias("margin"))


@query("c8_confidence_gate", "C8", f"SELECT user_id, day, outcome FROM ({GATED_SQL}) g")
def c8(spark, sf_dir):
    return gated(spark, sf_dir).select(*KEYS, "outcome")


@query("c8_outcome_counts", "C8", f"SELECT outcome, count(*) AS n FROM ({GATED_SQL}) g GROUP BY outcome")
def c8_counts(spark, sf_dir):
    return gated(spark, sf_dir).groupBy("outcome").agg(F.count("*").alias("n"))


@query("c9_gate_flags", "C9", f"""SELECT user_id, day,
    (outcome = 'not_understood')::INTEGER AS bot_question_incomprehension,
    (outcome = 'confused')::INTEGER AS bot_question_confusion FROM ({GATED_SQL}) g""")
def c9(spark, sf_dir):
    return C.gate_flags(gated(spark, sf_dir)).select(*KEYS, "bot_question_incomprehension", "bot_question_confusion")


@query("c9_gate_rates", "C9", f"""WITH f AS (SELECT day,
    (outcome = 'not_understood')::INTEGER AS i, (outcome = 'confused')::INTEGER AS c FROM ({GATED_SQL}) g)
  SELECT day, count(*) AS n_requests, sum(i)::BIGINT AS n_incomprehension, sum(c)::BIGINT AS n_confusion,
    round(avg(i), 6) AS incomprehension_rate, round(avg(c), 6) AS confusion_rate FROM f GROUP BY day""")
def c9_rates(spark, sf_dir):
    return C.gate_rates(C.gate_flags(gated(spark, sf_dir)), ["day"])


@query("c10_confused_pairs", "C10", f"""SELECT user_id, day,
    nullif(split_part(key1, '/', 2), '') AS id1, nullif(split_part(key2, '/', 2), '') AS id2
  FROM ({GATED_SQL}) g WHERE outcome = 'confused'""")
def c10(spark, sf_dir):
    return C.confused_pairs(gated(spark, sf_dir)).select(*KEYS, "id1", "id2")


# The clarification answer of a confused request is its latest event:
# click -> confusion_1, view -> confusion_2, error -> non_sense,
# purchase fills the left side slot, signup the middle one.
@query("c11_resolve_choice", "C11", f"""
WITH last_ev AS (SELECT user_id, day, event_type FROM (
    SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_type,
      row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d') ORDER BY ts DESC, event_id DESC) AS rn
    FROM events) WHERE rn = 1),
p AS (SELECT user_id, day, nullif(split_part(key1, '/', 2), '') AS id1, nullif(split_part(key2, '/', 2), '') AS id2
      FROM ({GATED_SQL}) g WHERE outcome = 'confused')
SELECT p.user_id, p.day, CASE l.event_type WHEN 'click' THEN 'confusion_1' WHEN 'view' THEN 'confusion_2'
    WHEN 'error' THEN 'non_sense' END AS choice_intent,
  CASE WHEN l.event_type IN ('click', 'purchase') THEN p.id1
       WHEN l.event_type IN ('view', 'signup') THEN p.id2 END AS chosen_id
FROM p JOIN last_ev l USING (user_id, day)""")
def c11(spark, sf_dir):
    ev = X.events(spark, sf_dir, "user_id", "day", "ts", "event_id", "event_type")
    last_ev = ev.groupBy(*KEYS).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type"))
    pairs = C.confused_pairs(gated(spark, sf_dir)).select(*KEYS, "id1", "id2")
    et = F.col("event_type")
    intent = (F.when(et == "click", F.lit(C.CHOICE_FIRST)).when(et == "view", F.lit(C.CHOICE_SECOND))
              .when(et == "error", F.lit(C.CHOICE_NONE)))
    return pairs.join(last_ev, KEYS).select(
        *KEYS, intent.alias("choice_intent"),
        C.resolve_choice(intent, F.col("id1"), F.col("id2"), left=et == "purchase", middle=et == "signup")
        .alias("chosen_id"),
    )


@query("c12_choice_rows", "C12", f"""
WITH p AS (SELECT user_id, day, key1, key2 FROM ({GATED_SQL}) g WHERE outcome = 'confused')
SELECT user_id, day, 1 AS pos, key1 AS title, '/confusion_1' AS payload FROM p
UNION ALL SELECT user_id, day, 2, key2, '/confusion_2' FROM p
UNION ALL SELECT user_id, day, 3, 'autre', '/non_sense' FROM p""")
def c12(spark, sf_dir):
    pairs = C.confused_pairs(gated(spark, sf_dir))
    return C.choice_rows(pairs, KEYS, "key1", "key2")
