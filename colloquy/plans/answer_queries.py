"""Response-choice queries (E1-E8) over ``conversations``, ``events`` and
``benchmark``. Four conversations (id = conv_id div 4) share a variant bank: the
distinct assistant texts of all of them. A conversation's profile comes from the
length of its user texts; its history is everything its assistant has said (F4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.text import intent_id
from colloquy.operators import answers as E
from colloquy.operators.intents import top_two
from colloquy.operators.scan import turn_chunk
from colloquy.operators.state import uttered_history
from colloquy.plans import fixtures as X
from colloquy.plans.registry import query, sql_lit as L

SEED = "seed"

_BANK_SQL = """SELECT DISTINCT conv_id // 4 AS id, replace(text, chr(160), ' ') AS text
  FROM conversations WHERE role = 'assistant'"""
_REQ_SQL = "SELECT DISTINCT conv_id, conv_id // 4 AS id FROM conversations"
_QUARTILES_SQL = f"""SELECT id, trunc(quantile_cont(length(text), 0.25))::INTEGER AS q1,
    trunc(quantile_cont(length(text), 0.75))::INTEGER AS q3 FROM ({_BANK_SQL}) GROUP BY id"""
_PROFILE_SQL = """SELECT conv_id, CASE WHEN avg(length(text)) < 150 THEN 'short_utters'
    WHEN avg(length(text)) > 400 THEN 'long_utters' END AS profile
  FROM conversations WHERE role = 'user' GROUP BY conv_id"""
_HISTORY_SQL = """SELECT DISTINCT conv_id, replace(text, chr(160), ' ') AS text
  FROM conversations WHERE role = 'assistant'"""
_FILTER_SQL = """CASE WHEN p.profile = 'short_utters' THEN length(b.text) <= q.q1
    WHEN p.profile = 'long_utters' THEN length(b.text) >= q.q3 ELSE TRUE END"""
_WITH = f"""WITH req AS ({_REQ_SQL}), b AS ({_BANK_SQL}), q AS ({_QUARTILES_SQL}), p AS ({_PROFILE_SQL}), h AS ({_HISTORY_SQL})"""
_CANDS = "req JOIN b USING (id) JOIN q USING (id) LEFT JOIN p ON p.conv_id = req.conv_id"
_UNSAID = "NOT EXISTS (SELECT 1 FROM h WHERE h.conv_id = req.conv_id AND h.text = b.text)"


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """everything a conversation's assistant has said."""
    conv = X.conversations(spark, sf_dir)
    return uttered_history(conv.filter(F.col("role") == "assistant"), "conv_id", "turn")


def bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = history(spark, sf_dir)
    return said.select(F.floor(F.col("conv_id") / 4).alias("id"), "text").distinct()


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = X.conversations(spark, sf_dir)
    return conv.select("conv_id", F.floor(F.col("conv_id") / 4).alias("id")).distinct()


def candidates(spark: SparkSession, sf_dir: str, profile: DataFrame | None = None) -> DataFrame:
    """E7 -> E1 -> E2: the variants of each conversation's id that fit its profile."""
    b = bank(spark, sf_dir)
    profile = X.user_profile(spark, sf_dir) if profile is None else profile
    asked = E.lookup_variants(requests(spark, sf_dir).join(profile, "conv_id", "left"), b, "id")
    return E.profile_filter(asked, E.length_quartiles(b, "id"), "id")


def short_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: which short reply, never said before, should each conversation
    get? E7 -> E1 -> E2 (short) -> E3 (minus everything said, F4) -> E4."""
    short = requests(spark, sf_dir).select("conv_id", F.lit(E.PROFILE_SHORT).alias("profile"))
    left = E.exclude_uttered(candidates(spark, sf_dir, short), history(spark, sf_dir), "conv_id")
    return E.pick_one(left, "conv_id", seed=SEED).select("conv_id", F.col("text").alias("reply"))


@query("e1_length_quartiles", "E1", _QUARTILES_SQL)
def e1(spark, sf_dir):
    return E.length_quartiles(bank(spark, sf_dir), "id")


@query("e2_profile_filter", "E2", f"{_WITH} SELECT req.conv_id, p.profile, b.text FROM {_CANDS} WHERE {_FILTER_SQL}")
def e2(spark, sf_dir):
    return candidates(spark, sf_dir).select("conv_id", "profile", "text")


@query("e3_exclude_uttered", "E3", f"{_WITH} SELECT req.conv_id, b.text FROM {_CANDS} WHERE {_FILTER_SQL} AND {_UNSAID}")
def e3(spark, sf_dir):
    return E.exclude_uttered(candidates(spark, sf_dir), history(spark, sf_dir), "conv_id").select("conv_id", "text")


_ORDER_SQL = f"ORDER BY md5(concat_ws('|', '{SEED}', req.conv_id::VARCHAR, b.text)), b.text"


@query("e4_pick_one", "E4", f"""{_WITH},
r AS (SELECT req.conv_id, b.text, row_number() OVER (PARTITION BY req.conv_id {_ORDER_SQL}) AS rn
      FROM req JOIN b USING (id) JOIN q USING (id) WHERE length(b.text) <= q.q1 AND {_UNSAID})
SELECT conv_id, text AS reply FROM r WHERE rn = 1""")
def e4(spark, sf_dir):
    return short_reply(spark, sf_dir)


@query("e5_answer_or_fallback", "E5", f"""{_WITH},
r AS (SELECT req.conv_id, b.text, row_number() OVER (PARTITION BY req.conv_id {_ORDER_SQL}) AS rn
      FROM {_CANDS} WHERE {_FILTER_SQL} AND {_UNSAID})
SELECT req.conv_id, p.profile, r.text IS NULL AS is_fallback,
  coalesce(r.text, CASE WHEN p.profile = 'short_utters' THEN {L(E.FALLBACK_WITH_CHOICE.format(choice=E.CHOICE_SHORT))}
                        WHEN p.profile = 'long_utters' THEN {L(E.FALLBACK_WITH_CHOICE.format(choice=E.CHOICE_LONG))}
                        ELSE {L(E.FALLBACK_PLAIN)} END) AS answer
FROM req LEFT JOIN p ON p.conv_id = req.conv_id LEFT JOIN (SELECT * FROM r WHERE rn = 1) r ON r.conv_id = req.conv_id""")
def e5(spark, sf_dir):
    left = E.exclude_uttered(candidates(spark, sf_dir), history(spark, sf_dir), "conv_id")
    picks = E.pick_one(left, "conv_id", seed=SEED)
    asked = requests(spark, sf_dir).join(X.user_profile(spark, sf_dir), "conv_id", "left")
    return E.answer_or_fallback(asked, picks, "conv_id").select("conv_id", "profile", "is_fallback", "answer")


@query("e6_answer_guard", "E6", f"""
WITH s AS (SELECT conv_id, bool_or(role = 'assistant') AS has_bot, bool_or(role = 'user') AS has_user
           FROM conversations GROUP BY conv_id)
SELECT conv_id,
  CASE WHEN NOT has_bot THEN {L(E.GUARD_NO_QUESTION_REFORMULATE)}
       WHEN NOT has_user THEN {L(E.GUARD_NOT_UNDERSTOOD_REFORMULATE)} END AS guard_reformulate,
  CASE WHEN NOT has_bot AND NOT has_user THEN {L(E.GUARD_NO_QUESTION_ADAPTIVE)}
       WHEN NOT has_user THEN {L(E.GUARD_NOT_UNDERSTOOD_ADAPTIVE)} END AS guard_adaptive
FROM s""")
def e6(spark, sf_dir):
    conv = X.conversations(spark, sf_dir)
    s = conv.groupBy("conv_id").agg(
        F.bool_or(F.col("role") == "assistant").alias("has_bot"),
        F.bool_or(F.col("role") == "user").alias("has_user"),
    )
    return s.select(
        "conv_id",
        E.answer_guard(F.col("has_bot"), F.col("has_user"), "reformulate").alias("guard_reformulate"),
        E.answer_guard(F.col("has_bot"), F.col("has_user"), "adaptive", F.col("has_user")).alias("guard_adaptive"),
    )


@query("e7_lookup_variants", "E7", """
WITH r AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_id,
             row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d')
               ORDER BY json_extract_string(props, '$.k')::INTEGER DESC, event_id) AS rk FROM events),
req AS (SELECT user_id, day, event_id % 10 AS id FROM r WHERE rk = 1)
SELECT req.user_id, req.day, req.id, b.item_id FROM req JOIN (SELECT item_id, item_id % 10 AS id FROM benchmark) b USING (id)""")
def e7(spark, sf_dir):
    top = top_two(X.ranking_rows(spark, sf_dir), ["user_id", "day"])
    requests = top.select("user_id", "day", (intent_id("key1").cast("bigint") % 10).alias("id"))
    variants = X.benchmark(spark, sf_dir).select("item_id", (F.col("item_id") % 10).alias("id"))
    return E.lookup_variants(requests, variants, "id").select("user_id", "day", "id", "item_id")


@query("e8_repeat_last", "E8", """
WITH w AS (SELECT conv_id, turn, role,
  last_value(CASE WHEN role = 'assistant' THEN text END IGNORE NULLS) OVER (
    PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS repeated
  FROM conversations)
SELECT conv_id, turn, repeated FROM w WHERE role = 'user' AND turn > 0""")
def e8(spark, sf_dir):
    conv = X.conversations(spark, sf_dir).withColumn(
        "reformulation", F.when(F.col("role") == "assistant", F.col("text"))
    ).withColumn("intent", F.when((F.col("role") == "user") & (F.col("turn") > 0), F.lit("affirm")))
    out = E.repeat_last(conv, "conv_id", "turn", "reformulation", "intent", chunk=turn_chunk())
    return out.select("conv_id", "turn", "repeated")
