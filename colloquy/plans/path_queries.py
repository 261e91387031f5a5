"""Rule and path queries (G1-G3) over ``events``.

Fixture: an event's intent is one of the rules' intents, picked by k; an ``error``
is a step of the bot itself (no intent). The loop active at its start follows the
user's previous event (click rating form, purchase and view password forms, signup
e-mail form); an ``error`` has submitted it, so no loop is left. The last action is
the submitted form, the form just left, or the history action after an ``error``.
The slot ``confusion`` is ``true`` when the request (user, day) is confused,
``misspelled_password`` when k is even. Steps are event types ordered by (ts, event_id).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.operators import paths as G
from colloquy.operators.scan import carry_last, time_chunk
from colloquy.plans import fixtures as X
from colloquy.plans.gate_queries import GATED_SQL, gated
from colloquy.plans.registry import query, sql_lit as L

INTENTS = sorted({v for _, _, kind, v in G.RULE_STEPS if kind == "intent"})
LOOPS = {"click": G.FORM, "purchase": "check_password_form", "view": "retry_password_form", "signup": "askingEmail_form"}
HISTORY = "action_bot_utterances_list"
PATHS = [
    ("choice", 1, "click"), ("choice", 2, "view"), ("choice", 2, "purchase"), ("choice", 3, "click"),
    ("trouble", 1, "error"), ("trouble", 2, "error"),
    ("visit", 1, "signup"), ("visit", 2, "view"), ("visit", 3, "click"), ("visit", 4, "purchase"), ("visit", 4, "view"),
]
EV_KEYS, EV_ORDER = ["user_id"], ["ts", "event_id"]


def _needs():
    """Per rule what it asks for, worked out here for the oracle."""
    rules = {}
    for rule, pos, kind, value in G.RULE_STEPS:
        rules.setdefault(rule, []).append((pos, kind, value))
    for rule, steps in rules.items():
        steps.sort()
        intents = [(p, v) for p, k, v in steps if k == "intent"]
        acts = [(p, v) for p, k, v in steps if k == "action"]
        wait = intents[-1][0] if intents else acts[0][0]
        answer = [(p, v) for p, v in acts if p > wait]
        loops = [v or "" for p, k, v in steps if k == "loop" and p < answer[0][0]]
        slots = dict(v.split("=") for _, k, v in steps if k == "slot")
        yield (rule, intents[-1][1] if intents else None, next((v for _, k, v in steps if k == "condition"), None),
               next((v for p, v in reversed(acts) if p <= wait), None), loops[-1] if loops else None,
               slots.get("confusion"), slots.get("misspelled_password"), ",".join(v for _, v in answer))


def _nullable(v):
    return "NULL" if v is None else L(v)


_RULES_SQL = "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(_nullable, r)) + ")" for r in _needs()) + \
    ") AS t(rule, intent, cond, last_action, loop_now, confusion, misspelled, actions)"
_K = "json_extract_string(props, '$.k')::INTEGER"
_INTENT_SQL = f"CASE WHEN event_type <> 'error' THEN [{', '.join(map(L, INTENTS))}][{_K} % {len(INTENTS)} + 1] END"
_LOOP_SQL = "CASE prev " + " ".join(f"WHEN {L(k)} THEN {L(v)}" for k, v in LOOPS.items()) + " END"


@query("g1_rule_lookup", "G1", f"""
WITH p AS (SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS day, event_type, {_INTENT_SQL} AS intent,
    CASE WHEN {_K} % 2 = 0 THEN 'true' ELSE '' END AS misspelled,
    lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
e AS (SELECT *, {_LOOP_SQL} AS active_loop,
    CASE WHEN event_type = 'error' THEN '' ELSE coalesce({_LOOP_SQL}, '') END AS loop_now,
    CASE WHEN prev = 'error' THEN {L(HISTORY)} ELSE {_LOOP_SQL} END AS last_action FROM p),
g AS ({GATED_SQL}),
ev AS (SELECT e.*, CASE WHEN g.outcome = 'confused' THEN 'true' ELSE '' END AS confusion
       FROM e LEFT JOIN g USING (user_id, day)),
m AS (SELECT ev.event_id, r.rule, r.actions,
        row_number() OVER (PARTITION BY ev.event_id ORDER BY
          (r.cond IS NOT NULL)::INTEGER + (r.last_action IS NOT NULL)::INTEGER + (r.loop_now IS NOT NULL)::INTEGER
          + (r.confusion IS NOT NULL)::INTEGER + (r.misspelled IS NOT NULL)::INTEGER DESC, r.rule) AS rn
      FROM ev JOIN ({_RULES_SQL}) r ON r.intent IS NOT DISTINCT FROM ev.intent
        AND (r.cond IS NULL OR r.cond = ev.active_loop) AND (r.last_action IS NULL OR r.last_action = ev.last_action)
        AND (r.loop_now IS NULL OR r.loop_now = ev.loop_now) AND (r.confusion IS NULL OR r.confusion = ev.confusion)
        AND (r.misspelled IS NULL OR r.misspelled = ev.misspelled))
SELECT e.event_id, m.rule, m.actions FROM e LEFT JOIN (SELECT * FROM m WHERE rn = 1) m USING (event_id)""")
def g1(spark, sf_dir):
    ev = X.events(spark, sf_dir, "event_id", "user_id", "ts", "day", "event_type", "k")
    ev = carry_last(ev, EV_KEYS, EV_ORDER, F.col("event_type"), "_prev", inclusive=False, chunk=time_chunk())
    bot = F.col("event_type") == "error"
    loop = F.coalesce(*[F.when(F.col("_prev") == k, F.lit(v)) for k, v in LOOPS.items()])
    conf = gated(spark, sf_dir).select("user_id", "day", (F.col("outcome") == "confused").alias("_confused"))
    ev = ev.join(conf, ["user_id", "day"], "left").select(
        "event_id",
        F.when(~bot, F.element_at(F.array(*map(F.lit, INTENTS)), F.col("k") % len(INTENTS) + 1)).alias("intent"),
        loop.alias("active_loop"), F.when(~bot, loop).alias("loop_now"),
        F.when(F.col("_prev") == "error", F.lit(HISTORY)).otherwise(loop).alias("last_action"),
        F.create_map(F.lit("confusion"), F.when(F.col("_confused"), F.lit("true")),
                     F.lit("misspelled_password"), F.when(F.col("k") % 2 == 0, F.lit("true"))).alias("slots"))
    return G.rule_lookup(ev, G.rules_frame(spark), "event_id")


_STEPS_SQL = """SELECT user_id, event_type,
    lag(event_type, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev1,
    lag(event_type, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev2,
    lag(event_type, 3) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev3 FROM events"""


@query("g2_path_conformance", "G2", f"""
WITH s AS ({_STEPS_SQL})
SELECT user_id, 'choice' AS path, count(*) AS n_matches FROM s
WHERE prev2 = 'click' AND prev1 IN ('view', 'purchase') AND event_type = 'click' GROUP BY user_id
UNION ALL SELECT user_id, 'trouble', count(*) FROM s WHERE prev1 = 'error' AND event_type = 'error' GROUP BY user_id
UNION ALL SELECT user_id, 'visit', count(*) FROM s WHERE prev3 = 'signup' AND prev2 = 'view' AND prev1 = 'click'
  AND event_type IN ('purchase', 'view') GROUP BY user_id""")
def g2(spark, sf_dir):
    ev = X.events(spark, sf_dir, "user_id", "ts", "event_id", "event_type")
    return G.path_conformance(ev, EV_KEYS, EV_ORDER, "event_type", G.literal_table(spark, PATHS, "path, pos, step"),
                              chunk=time_chunk())


@query("g3_next_action", "G3", f"""
WITH c AS (SELECT prev2, prev1, event_type AS next_step, count(*) AS n FROM ({_STEPS_SQL}) s
           WHERE prev2 IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY prev2, prev1 ORDER BY n DESC, next_step) AS rn FROM c)
SELECT prev2, prev1, next_step, n FROM r WHERE rn = 1""")
def g3(spark, sf_dir):
    ev = X.events(spark, sf_dir, "user_id", "ts", "event_id", "event_type")
    return G.next_action(ev, EV_KEYS, EV_ORDER, "event_type", chunk=time_chunk())


DEPTH, SUPPORT = 4, 20
_PREV = [f"prev{i}" for i in range(1, DEPTH + 1)]
_HISTORY_SQL = "SELECT *, " + ", ".join(
    f"lag(event_type, {i}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev{i}" for i in range(1, DEPTH + 1)) + " FROM events"


def _level_sql(d: int) -> str:
    at, rest = ", ".join(_PREV[:d]), "".join(f", NULL AS {c}" for c in _PREV[d:])
    return f"""SELECT {d} AS depth, {at}{rest}, sum(c)::BIGINT AS n, arg_min(event_type, (-c, event_type)) AS next_step, max(c) AS n_next
  FROM (SELECT {at}, event_type, count(*) AS c FROM h WHERE prev{d} IS NOT NULL GROUP BY ALL) GROUP BY {at} HAVING sum(c) >= {SUPPORT}"""


_TREE_SQL = f"WITH h AS ({_HISTORY_SQL}), tree AS ({' UNION ALL '.join(_level_sql(d) for d in range(1, DEPTH + 1))})"


def _tree(spark, sf_dir):
    ev = X.events(spark, sf_dir, "user_id", "ts", "event_id", "event_type")
    return ev, G.context_tree(ev, EV_KEYS, EV_ORDER, "event_type", DEPTH, SUPPORT, chunk=time_chunk())


@query("g3_context_tree", "G3", f"{_TREE_SQL} SELECT * FROM tree")
def g3_tree(spark, sf_dir):
    return _tree(spark, sf_dir)[1]


@query("g3_predicted_steps", "G3", _TREE_SQL + " SELECT user_id, event_id, " + "coalesce("
       + ", ".join(f"CASE WHEN t{d}.next_step IS NOT NULL THEN {d} END" for d in range(DEPTH, 0, -1)) + ", 0) AS context, coalesce("
       + ", ".join(f"t{d}.next_step" for d in range(DEPTH, 0, -1)) + ") AS predicted FROM h"
       + "".join(f" LEFT JOIN tree t{d} ON t{d}.depth = {d} AND " + " AND ".join(f"t{d}.{c} = h.{c}" for c in _PREV[:d])
                 for d in range(1, DEPTH + 1)))
def g3_predicted(spark, sf_dir):
    ev, tree = _tree(spark, sf_dir)
    out = G.predict_next(ev, tree, EV_KEYS, EV_ORDER, "event_type", DEPTH, chunk=time_chunk())
    return out.select("user_id", "event_id", "context", "predicted")
