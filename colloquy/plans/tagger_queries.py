"""The learned entity tagger (C5): trained on annotated ``benchmark`` texts, applied to every
turn of ``conversations``.

The training texts are stand-ins in the annotation format: a word of ten letters or more is
marked ``long``, a shorter word that begins the text ``start``. The oracle does the same
training and decoding in SQL, Viterbi's recursion included.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.functions.text import SPAN_PATTERN
from colloquy.operators import intents as C
from colloquy.operators import tagger as T
from colloquy.plans import fixtures as X
from colloquy.plans.registry import query, sql_lit as L

EPOCHS, BATCHES = 1, 6
_LONG, _START = r"(\p{L}{10,})", r"^(\p{L}+)"
TAGS = ["O", "B-long", "I-long", "B-start", "I-start"]


def examples(spark, sf_dir):
    marked = F.regexp_replace("text", _LONG, "[$1](long)")
    return X.benchmark(spark, sf_dir).select(F.regexp_replace(marked, _START, "[$1](start)").alias("text"))


def tagger(spark, sf_dir):
    return T.fit_tagger(examples(spark, sf_dir), epochs=EPOCHS, batches=BATCHES)


_TAGS_SQL = "(VALUES " + ", ".join(f"({n}, {L(t)})" for n, t in enumerate(TAGS)) + ") AS tags(t, tag)"


def viterbi_sql(name: str, tags: str) -> str:
    """CTEs from scores ``{name}_e`` (s, i, t, e) and transitions ``{name}_a`` (p, t, a; p = -1 at the
    start) to the best tags ``{name}`` (s, i, tag)."""
    return f"""
{name}_v AS (
  SELECT e.s, e.i, e.t, e.e + a.a AS score, -1 AS prev FROM {name}_e e JOIN {name}_a a ON a.p = -1 AND a.t = e.t WHERE e.i = 0
  UNION ALL
  SELECT s, i, t, score, prev FROM (
    SELECT v.s, e.i, e.t, v.score + a.a + e.e AS score, v.t AS prev,
           row_number() OVER (PARTITION BY v.s, e.t ORDER BY v.score + a.a DESC, v.t) AS rn
    FROM {name}_v v JOIN {name}_e e ON e.s = v.s AND e.i = v.i + 1 JOIN {name}_a a ON a.p = v.t AND a.t = e.t) WHERE rn = 1),
{name}_m AS MATERIALIZED (SELECT * FROM {name}_v),
{name}_l AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY i DESC, score DESC, t) AS rn FROM {name}_m),
{name}_b AS (
  SELECT s, i, t, prev FROM {name}_l WHERE rn = 1
  UNION ALL SELECT m.s, m.i, m.t, m.prev FROM {name}_b b JOIN {name}_m m ON m.s = b.s AND m.i = b.i - 1 AND m.t = b.prev),
{name} AS MATERIALIZED (SELECT b.s, b.i, tags.tag FROM {name}_b b JOIN {tags} ON tags.t = b.t)"""


def _tokens_sql(name: str, source: str, annotated: bool) -> str:
    """CTEs from ``source`` (r, text) to ``{name}`` (r, pos, q, i, token, tag) and its features."""
    piece = rf"{SPAN_PATTERN}|(?s:.)[^\[]*" if annotated else r"(?s:.)+"
    span = f"'^{SPAN_PATTERN}$'"
    entity = f"regexp_extract(piece, {span}, 2)" if annotated else "''"
    value = f"CASE WHEN entity = '' THEN piece ELSE regexp_extract(piece, {span}, 1) END" if annotated else "piece"
    return rf"""
{name}_p AS (SELECT r, unnest(regexp_extract_all(text, '{piece}')) AS piece,
    generate_subscripts(regexp_extract_all(text, '{piece}'), 1) AS pn FROM {source}),
{name}_e AS (SELECT *, {entity} AS entity FROM {name}_p),
{name}_w AS (SELECT r, pn, entity, regexp_extract_all({value}, '{C.ENTITY_TOKEN_RE}') AS ws FROM {name}_e),
{name}_t AS (SELECT r, pn, generate_subscripts(ws, 1) AS wn, unnest(ws) AS token, entity FROM {name}_w),
{name}_o AS (SELECT r, row_number() OVER (PARTITION BY r ORDER BY pn, wn) - 1 AS pos, token,
    CASE WHEN entity = '' THEN 'O' WHEN wn = 1 THEN 'B-' || entity ELSE 'I-' || entity END AS tag FROM {name}_t),
{name}_s AS (SELECT *, coalesce(sum(CASE WHEN token IN ('.', '!', '?') THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sent FROM {name}_o),
{name}_f AS (SELECT *, pos - min(pos) OVER (PARTITION BY r, sent) AS k FROM {name}_s),
{name} AS MATERIALIZED (SELECT r, pos, token, tag, dense_rank() OVER (ORDER BY r, sent, k // {T.PART}) AS s,
    k % {T.PART} AS i FROM {name}_f),
{name}_n AS (SELECT *, lag(token) OVER (PARTITION BY s ORDER BY i) AS before, lead(token) OVER (PARTITION BY s ORDER BY i) AS after
    FROM {name}),
{name}_x AS MATERIALIZED (SELECT s, i, unnest(['w=' || lower(token), 'p=' || coalesce(lower(before), ''),
    'n=' || coalesce(lower(after), ''), 'e=' || right(lower(token), {T.ENDING}),
    'h=' || regexp_replace(regexp_replace(regexp_replace(token, '\p{{Lu}}+', 'A', 'g'), '\p{{Ll}}+', 'a', 'g'), '\p{{N}}+', '0', 'g'),
    'l=' || least(length(token), {T.LONGEST})::VARCHAR]) AS feature FROM {name}_n)"""


def _decode_sql(name: str, tokens: str, features: str, weights: str) -> str:
    """CTEs to ``{name}`` (s, i, t): the best tag of every token by the weights."""
    return f"""
{name}_e AS MATERIALIZED (SELECT x.s, x.i, tags.t, coalesce(sum(w.w), 0) AS e
    FROM {features} x CROSS JOIN {_TAGS_SQL} LEFT JOIN {weights} w ON w.feature = x.feature AND w.tag = tags.tag
    GROUP BY x.s, x.i, tags.t),
{name}_a AS MATERIALIZED (SELECT p.t AS p, n.t, coalesce(w.w, 0) AS a FROM (SELECT t, tag FROM {_TAGS_SQL} UNION ALL SELECT -1, '^') p
    CROSS JOIN {_TAGS_SQL.replace("tags(t", "n(t")} LEFT JOIN {weights} w ON w.feature = 't=' || p.tag AND w.tag = n.tag),
{viterbi_sql(name, _TAGS_SQL)}"""


def _round_sql(n: int) -> str:
    """The n-th batch: weights w{n} to w{n + 1}."""
    some = f"(SELECT x.* FROM b_x x JOIN b_k k ON k.s = x.s AND k.batch = {n % BATCHES})"
    return f"""{_decode_sql(f"d{n}", "b", some, f"w{n}")},
g{n} AS (SELECT b.s, b.i, b.tag AS gold, d.tag AS guess, bool_or(b.tag <> d.tag) OVER (PARTITION BY b.s) AS wrong,
    lag(b.tag, 1, '^') OVER (PARTITION BY b.s ORDER BY b.i) AS gold0, lag(d.tag, 1, '^') OVER (PARTITION BY b.s ORDER BY b.i) AS guess0
    FROM b JOIN d{n} d ON d.s = b.s AND d.i = b.i),
m{n} AS (
  SELECT feature, gold AS tag, 1 AS w FROM g{n} JOIN b_x USING (s, i) WHERE gold <> guess
  UNION ALL SELECT feature, guess, -1 FROM g{n} JOIN b_x USING (s, i) WHERE gold <> guess
  UNION ALL SELECT 't=' || gold0, gold, 1 FROM g{n} WHERE wrong UNION ALL SELECT 't=' || guess0, guess, -1 FROM g{n} WHERE wrong),
w{n + 1} AS MATERIALIZED (SELECT feature, tag, sum(w)::BIGINT AS w FROM (
  SELECT feature, tag, sign(sum(w))::BIGINT AS w FROM m{n} GROUP BY ALL UNION ALL SELECT * FROM w{n}) GROUP BY ALL HAVING sum(w) <> 0)"""


_ROUNDS = EPOCHS * BATCHES
_FIT_SQL = rf"""WITH RECURSIVE src AS (
  SELECT row_number() OVER () AS r, regexp_replace(regexp_replace(text, '{_LONG}', '[\1](long)', 'g'), '{_START}', '[\1](start)') AS text
  FROM benchmark),{_tokens_sql("b", "src", True)},
b_k AS (SELECT s, ('0x' || md5(string_agg(token, ' ' ORDER BY i))[1:8])::BIGINT % {BATCHES} AS batch FROM b GROUP BY s),
w0 AS (SELECT '' AS feature, '' AS tag, 0::BIGINT AS w WHERE false),{",".join(_round_sql(n) for n in range(_ROUNDS))},
model AS MATERIALIZED (SELECT feature, tag, sum(w)::BIGINT AS w FROM ({" UNION ALL ".join(
    f"SELECT * FROM w{n + 1}" for n in range(_ROUNDS))}) GROUP BY ALL HAVING sum(w) <> 0)"""


@query("c5_tagger_weights", "C5", f"{_FIT_SQL}\nSELECT feature, tag, w FROM model")
def c5_weights(spark, sf_dir):
    return tagger(spark, sf_dir).weights


@query("c5_tagged_entities", "C5", rf"""{_FIT_SQL},
turns AS (SELECT row_number() OVER () AS r, conv_id, turn, text FROM conversations),{_tokens_sql("c", "turns", False)},
{_decode_sql("z", "c", "c_x", "model")},
y AS (SELECT c.r, c.pos, c.s, c.i, c.token, z.tag, substr(z.tag, 3) AS entity, lag(z.tag, 1, 'O') OVER (PARTITION BY c.s ORDER BY c.i) AS tag0
      FROM c JOIN z ON z.s = c.s AND z.i = c.i),
q AS (SELECT *, sum(CASE WHEN tag = 'O' OR tag LIKE 'B-%' OR tag0 = 'O' OR substr(tag0, 3) <> entity THEN 1 ELSE 0 END)
        OVER (PARTITION BY s ORDER BY i) AS span FROM y),
found AS (SELECT r, s, span, entity, min(pos) AS start, count(*) AS n, string_agg(token, ' ' ORDER BY i) AS value
          FROM q WHERE tag <> 'O' GROUP BY ALL)
SELECT conv_id, turn, start::INTEGER AS start, n::INTEGER AS n_tokens, value, entity FROM found JOIN turns USING (r)""")
def c5_entities(spark, sf_dir):
    model = tagger(spark, sf_dir)
    turns = X.conversations(spark, sf_dir).select("conv_id", "turn", "text")
    return T.find_entities(turns, model, ["conv_id", "turn"])
