"""A question being answered, end to end: rank the
candidates of each request, gate by confidence, then per outcome:

* ``answer``: all variants of the best id (E7), quartiles of their lengths
  (E1), the user's profile filter (E2), one seeded pick (E4), with the
  fallback text when the profile leaves nothing (E5);
* ``confused``: the clarification title and three buttons: the keyword that
  separates each of the two ids from the other (C10, D1-D6), and "autre" (C12);
* ``not_understood``: the template with the formatted confidence (B6, B7);
* ``no_ranking``: nothing is sent.

Bank: ``benchmark`` with id = item_id % 10; request id = best event_id % 10. For the
keywords an item is a response when item_id div 10 is even, else a question; each
pair of ids that occurs is worked out once, not per request. Ids without a keyword
of their own (both the same, or no text) show the candidate's key.
Profile: the user's latest profile event (click short, view long, purchase
indifferent). The direct answer ignores history, as the reference does.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.functions.text import format_confidence, intent_id, render_template
from colloquy.operators import answers as E
from colloquy.operators import intents as C
from colloquy.operators import keywords as D
from colloquy.plans import fixtures as X
from colloquy.plans.gate_queries import GATED_SQL, gated as gated_requests
from colloquy.plans.keyword_queries import table_sql
from colloquy.plans.registry import query, sql_lit as L
from colloquy.plans.text_queries import TEMPLATES

SEED = "seed"
DONT_UNDERSTAND = dict(TEMPLATES)["utter_dont_understand"]
KEYS = ["user_id", "day"]


def _bank_id(key):
    return intent_id(key).cast("bigint") % 10


def confused_choices(spark, sf_dir):
    """C10 -> D1-D6 -> C12: three button rows per confused request."""
    asked = C.confused_pairs(gated_requests(spark, sf_dir)).select(
        *KEYS, "key1", "key2", _bank_id("key1").alias("a"), _bank_id("key2").alias("b"))
    pair = F.least("a", "b") * 10 + F.greatest("a", "b")
    asked = asked.withColumn("pair_id", F.when(F.col("a") != F.col("b"), pair))
    occurring = asked.select("pair_id").where("pair_id is not null").distinct()
    pairs = occurring.select("pair_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("side")).select(
        "pair_id", F.col("side").cast("bigint").alias("side"),
        F.when(F.col("side") == 0, F.expr("pair_id div 10")).otherwise(F.col("pair_id") % 10).alias("id"))
    items = X.benchmark(spark, sf_dir).select((F.col("item_id") % 10).alias("id"), F.col("item_id").alias("doc_id"), "text")
    response = F.expr("(doc_id div 10) % 2 = 0")
    corpus = D.pair_corpus(pairs, items.where(response), items.where(~response))
    best = D.top_keyword(D.keyword_table(corpus), ["pair_id", "side"]).select("pair_id", "side", "keyword")
    both = best.groupBy("pair_id").agg(F.max(F.when(F.col("side") == 0, F.col("keyword"))).alias("_low"),
                                       F.max(F.when(F.col("side") == 1, F.col("keyword"))).alias("_high"))
    titled = asked.join(both, "pair_id", "left").select(
        *KEYS,
        F.coalesce(F.when(F.col("a") < F.col("b"), F.col("_low")).otherwise(F.col("_high")), "key1").alias("title1"),
        F.coalesce(F.when(F.col("a") < F.col("b"), F.col("_high")).otherwise(F.col("_low")), "key2").alias("title2"))
    return C.choice_rows(titled, KEYS, "title1", "title2")


_CONFUSED_SQL = f"""SELECT user_id, day, key1, key2, split_part(key1, '/', 2)::BIGINT % 10 AS a,
    split_part(key2, '/', 2)::BIGINT % 10 AS b FROM ({GATED_SQL}) WHERE outcome = 'confused'"""
_PAIR_CORPUS_SQL = f"""SELECT pr.pair_id, s.side, b.item_id AS doc_id, b.text,
    count(*) OVER (PARTITION BY pr.pair_id, s.side) AS n_texts
  FROM (SELECT DISTINCT least(a, b) * 10 + greatest(a, b) AS pair_id FROM ({_CONFUSED_SQL}) WHERE a <> b) pr,
    (VALUES (0), (1)) s(side), benchmark b
  WHERE b.item_id % 10 = CASE s.side WHEN 0 THEN pr.pair_id // 10 ELSE pr.pair_id % 10 END"""
_TITLES_SQL = f"""{table_sql(_PAIR_CORPUS_SQL)},
best AS (SELECT pair_id, side, word FROM (SELECT *, row_number() OVER (
           PARTITION BY pair_id, side ORDER BY score DESC, word) AS rn FROM s) WHERE rn = 1),
asked AS ({_CONFUSED_SQL}),
titled AS (SELECT user_id, day, coalesce(k1.word, key1) AS title1, coalesce(k2.word, key2) AS title2 FROM asked
  LEFT JOIN best k1 ON a <> b AND k1.pair_id = least(a, b) * 10 + greatest(a, b) AND k1.side = (a > b)::INTEGER
  LEFT JOIN best k2 ON a <> b AND k2.pair_id = least(a, b) * 10 + greatest(a, b) AND k2.side = (b > a)::INTEGER)"""


@query("respond_confused", "C12", f"""
WITH {_TITLES_SQL}
SELECT user_id, day, 1 AS pos, title1 AS title, '/confusion_1' AS payload FROM titled
UNION ALL SELECT user_id, day, 2, title2, '/confusion_2' FROM titled
UNION ALL SELECT user_id, day, 3, 'autre', '/non_sense' FROM titled""")
def respond_confused(spark, sf_dir):
    return confused_choices(spark, sf_dir)


def respond(spark, sf_dir):
    gated = gated_requests(spark, sf_dir)
    ev = X.events(spark, sf_dir, "user_id", "ts", "event_id", "event_type")
    prof_ev = ev.filter(F.col("event_type").isin(list(X.PROFILE_INTENTS)))
    profile = prof_ev.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("_pe"))
    profile = profile.select("user_id", F.coalesce(*[F.when(F.col("_pe") == k, F.lit(v))
                                                    for k, v in X.PROFILE_INTENTS.items()]).alias("profile"))
    bank = X.benchmark(spark, sf_dir).select((F.col("item_id") % 10).alias("id"), "text")
    quart = E.length_quartiles(bank, "id")

    answered = gated.filter(F.col("outcome") == C.OUTCOME_ANSWER).select(
        *KEYS, (intent_id("key1").cast("bigint") % 10).alias("id")).join(profile, "user_id", "left")
    variants = E.lookup_variants(answered, bank, "id")
    fitting = E.profile_filter(variants, quart, "id")
    picks = E.pick_one(fitting, KEYS, seed=SEED)
    answers = E.answer_or_fallback(answered, picks, KEYS).select(*KEYS, F.col("answer").alias("_answer"))

    msg = (F.when(F.col("outcome") == C.OUTCOME_ANSWER, F.col("_answer"))
           .when(F.col("outcome") == C.OUTCOME_CONFUSED, F.lit(C.CLARIFY_TITLE))
           .when(F.col("outcome") == C.OUTCOME_NOT_UNDERSTOOD,
                 render_template(F.lit(DONT_UNDERSTAND), name=format_confidence(F.col("conf1")))))
    shown = confused_choices(spark, sf_dir).groupBy(*KEYS).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "title", "payload"))),  # three rows
        lambda x: F.concat(x["title"], F.lit(" "), x["payload"])), " | ").alias("buttons"))
    return gated.join(answers, KEYS, "left").join(shown, KEYS, "left").select(
        *KEYS, "outcome", msg.alias("response"), "buttons")


_FALLBACK_SQL = f"""CASE WHEN a.profile = 'short_utters' THEN {L(E.FALLBACK_WITH_CHOICE.format(choice=E.CHOICE_SHORT))}
    WHEN a.profile = 'long_utters' THEN {L(E.FALLBACK_WITH_CHOICE.format(choice=E.CHOICE_LONG))}
    ELSE {L(E.FALLBACK_PLAIN)} END"""


@query("respond_requests", "E5", f"""
WITH {_TITLES_SQL}, g AS ({GATED_SQL}),
pe AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
       FROM events WHERE event_type IN ('click', 'view', 'purchase')),
p AS (SELECT user_id, CASE event_type WHEN 'click' THEN 'short_utters' WHEN 'view' THEN 'long_utters'
        ELSE 'dont_care' END AS profile FROM pe WHERE rn = 1),
bk AS (SELECT item_id % 10 AS id, text FROM benchmark),
q AS (SELECT id, trunc(quantile_cont(length(text), 0.25))::INTEGER AS q1,
        trunc(quantile_cont(length(text), 0.75))::INTEGER AS q3 FROM bk GROUP BY id),
a AS (SELECT g.user_id, g.day, split_part(g.key1, '/', 2)::BIGINT % 10 AS id, p.profile
      FROM g LEFT JOIN p USING (user_id) WHERE g.outcome = 'answer'),
cd AS (SELECT a.user_id, a.day, bk.text FROM a JOIN bk USING (id) JOIN q USING (id)
      WHERE CASE WHEN a.profile = 'short_utters' THEN length(bk.text) <= q.q1
                 WHEN a.profile = 'long_utters' THEN length(bk.text) >= q.q3 ELSE TRUE END),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, day
        ORDER BY md5(concat_ws('|', '{SEED}', user_id::VARCHAR, day, text)), text) AS rn FROM cd),
ans AS (SELECT a.user_id, a.day, coalesce(r.text, {_FALLBACK_SQL}) AS answer
        FROM a LEFT JOIN (SELECT * FROM r WHERE rn = 1) r USING (user_id, day))
SELECT g.user_id, g.day, g.outcome,
  CASE g.outcome WHEN 'answer' THEN ans.answer
    WHEN 'confused' THEN {L(C.CLARIFY_TITLE)}
    WHEN 'not_understood' THEN replace({L(DONT_UNDERSTAND)}, '{{name}}',
      round(100.0::DOUBLE * g.conf1, 2)::VARCHAR || ' %') END AS response,
  CASE g.outcome WHEN 'confused' THEN titled.title1 || ' /confusion_1 | ' || titled.title2 || ' /confusion_2 | '
    || 'autre /non_sense' END AS buttons
FROM g LEFT JOIN ans USING (user_id, day) LEFT JOIN titled USING (user_id, day)""")
def respond_requests(spark, sf_dir):
    return respond(spark, sf_dir)
