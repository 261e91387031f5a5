"""Tokens, intent model, response ranking and entity matching.

C3 learns (quality, toxic) as one label of four classes from ``labels``; C4 ranks
the ``benchmark`` bank for every user turn of ``conversations``; C5's gazetteer
comes from annotated examples (B10): in each benchmark item the first two tokens
are marked ``start``, the longest word ``long``; it is matched in every document.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.functions.text import extract_annotations
from colloquy.operators import intents as C
from colloquy.operators import selector as S
from colloquy.plans import fixtures as X
from colloquy.plans.registry import query

_TOKENS_SQL = r"""WITH t AS (SELECT doc_id, string_split_regex(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+') AS toks
           FROM documents)
SELECT doc_id, i::INTEGER AS pos, toks[i] AS token FROM t, range(1, len(toks) + 1) r(i) WHERE toks[i] <> ''"""


@query("c1_tokenize", "C1", _TOKENS_SQL)
def c1(spark, sf_dir):
    return C.tokenize(X.documents(spark, sf_dir, "doc_id", "text"), ["doc_id"])


@query("c2_token_counts", "C2", f"SELECT doc_id, token, count(*) AS n FROM ({_TOKENS_SQL}) GROUP BY ALL")
def c2(spark, sf_dir):
    return C.token_counts(C.tokenize(X.documents(spark, sf_dir, "doc_id", "text"), ["doc_id"]), ["doc_id"])


@query("c3_intent_model", "C3", r"""
WITH lab AS (SELECT doc_id, quality * 2 + toxic AS label FROM labels JOIN documents USING (doc_id)),
dw AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS token FROM documents),
tf AS (SELECT doc_id, token, count(*) AS tf FROM dw GROUP BY ALL),
tr AS (SELECT label, token, sum(tf) AS n FROM tf JOIN lab USING (doc_id) GROUP BY ALL),
v AS (SELECT count(DISTINCT token) AS v FROM tr),
pr AS (SELECT label, round(1000000 * ln(count(*)::DOUBLE / (SELECT count(*) FROM lab)))::BIGINT AS p FROM lab GROUP BY label),
tot AS (SELECT label, sum(n) + (SELECT v FROM v) AS t FROM tr GROUP BY label),
w AS (SELECT label, token, round(1000000 * ln((n + 1.0::DOUBLE) / t))::BIGINT AS w FROM tr JOIN tot USING (label)),
u AS (SELECT label, round(1000000 * ln(1.0::DOUBLE / t))::BIGINT AS u FROM tot),
sc AS (SELECT d.doc_id, pr.label, any_value(pr.p) + coalesce(sum(tf.tf * coalesce(w.w, u.u)), 0) AS s
       FROM documents d CROSS JOIN pr JOIN u ON u.label = pr.label LEFT JOIN tf ON tf.doc_id = d.doc_id
       LEFT JOIN w ON w.label = pr.label AND w.token = tf.token GROUP BY d.doc_id, pr.label),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, label) AS rn FROM sc)
SELECT doc_id, label AS prediction, s::DOUBLE / 1000000 AS score FROM r WHERE rn = 1""")
def c3(spark, sf_dir):
    docs = X.documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        "doc_id", (F.col("quality") * 2 + F.col("toxic")).alias("label"))
    model = C.fit_intents(docs.join(labels, "doc_id"))
    return C.predict_intents(model, docs, ["doc_id"]).select("doc_id", "prediction", "score")


@query("c4_rank_responses", "C4", r"""
WITH bw0 AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS token FROM benchmark),
btf AS (SELECT item_id, token, count(*) AS tf FROM bw0 GROUP BY ALL),
idf AS (SELECT token, ln((SELECT count(DISTINCT item_id) FROM benchmark)::DOUBLE / count(*)) AS idf
        FROM btf GROUP BY token),
idf2 AS (SELECT * FROM idf WHERE idf > 0),
bw AS (SELECT item_id, token, tf * idf AS wb FROM btf JOIN idf2 USING (token)),
bn AS (SELECT item_id, sqrt(sum(wb * wb)) AS nb FROM bw GROUP BY item_id),
qw0 AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS token
        FROM conversations WHERE role = 'user'),
qtf AS (SELECT conv_id, turn, token, count(*) AS tf FROM qw0 GROUP BY ALL),
qw AS (SELECT conv_id, turn, token, tf * idf AS wq FROM qtf JOIN idf2 USING (token)),
qn AS (SELECT conv_id, turn, sqrt(sum(wq * wq)) AS nq FROM qw GROUP BY ALL),
d AS (SELECT conv_id, turn, item_id, sum(wq * wb) AS dot FROM qw JOIN bw USING (token) GROUP BY ALL),
c AS (SELECT conv_id, turn, item_id, round(dot / (nq * nb), 6) AS cosine
      FROM d JOIN qn USING (conv_id, turn) JOIN bn USING (item_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY cosine DESC, item_id) AS rank FROM c)
SELECT conv_id, turn, item_id, rank::INTEGER AS rank, cosine,
  round(cosine / sum(cosine) OVER (PARTITION BY conv_id, turn), 6) AS confidence
FROM r WHERE rank <= 3""")
def c4(spark, sf_dir):
    conv = X.conversations(spark, sf_dir).filter(F.col("role") == "user").select("conv_id", "turn", "text")
    ranked = C.rank_responses(conv, X.benchmark(spark, sf_dir), ["conv_id", "turn"], k=3)
    return ranked.select("conv_id", "turn", "item_id", "rank", "cosine", "confidence")


# no SQL: the space is learned by alternating least squares
@query("c4_selected_responses", "C4")
def c4_selected(spark, sf_dir):
    """Learned from all user and assistant turns of a conversation; asked by the user turns of the
    conversations whose id is divisible by 100, among all assistant turns."""
    conv = X.conversations(spark, sf_dir).withColumn("id", F.col("conv_id"))
    own = F.col("conv_id") * 10_000 + F.col("turn")
    users, bots = conv.where("role = 'user'"), conv.where("role = 'assistant'")
    model = S.fit_selector(users.select("id", "text"), bots.select("id", "text"), rank=16, rounds=5)
    asked = users.where("conv_id % 100 = 0").select(own.alias("query"), "text")
    return S.select_responses(asked, bots.select(own.alias("item_id"), "text"), model, 3)


_FIRST_TWO = r"^\s*([^\s\[\]()]+\s[^\s\[\]()]+)"


def gazetteer(spark, sf_dir):
    b = X.benchmark(spark, sf_dir)
    words = F.regexp_extract_all("text", F.lit(C.WORD_RE), 0)
    longest = F.array_min(F.transform(words, lambda w: F.struct((-F.char_length(w)).alias("l"), w.alias("w"))))["w"]
    example = F.concat(F.lit("["), F.regexp_extract("text", _FIRST_TWO, 1), F.lit("](start) et ["), longest, F.lit("](long)"))
    return extract_annotations(b.select("item_id", example.alias("text")), keys=["item_id"]).select("value", "entity")


@query("c5_entity_match", "C5", rf"""
WITH b AS (SELECT text, regexp_extract_all(text, '\p{{L}}+') AS ws FROM benchmark),
g AS (SELECT regexp_extract(text, '{_FIRST_TWO}', 1) AS value, 'start' AS entity FROM b
      UNION SELECT list_sort(list_transform(ws, lambda w: {{'l': -length(w), 'w': w}}))[1].w, 'long' FROM b),
gaz AS (SELECT DISTINCT lower(value) AS value, entity,
          ' ' || array_to_string(regexp_extract_all(lower(value), '{C.ENTITY_TOKEN_RE}'), ' ') || ' ' AS run
        FROM g WHERE value <> ''),
d AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '{C.ENTITY_TOKEN_RE}'), ' ') || ' ' AS run
      FROM documents)
SELECT DISTINCT d.doc_id, gaz.value, gaz.entity FROM d JOIN gaz ON contains(d.run, gaz.run)""")
def c5(spark, sf_dir):
    docs = X.documents(spark, sf_dir, "doc_id", "text")
    return C.entity_match(docs, gazetteer(spark, sf_dir), ["doc_id"])
