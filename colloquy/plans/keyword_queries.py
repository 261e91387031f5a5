"""Contrastive-keyword queries (D1-D6) over the French ``documents``.

Fixture: id = doc_id % 10; ids form the pairs (0,1) (2,3) ... (8,9), so
pair_id = id div 2 and side = id % 2; a document is a response when
doc_id div 10 is even, else a question. Every French text takes part.
The oracle compares every word with every cleaned text of its pair
(brute force); the Spark side uses the gram index of ``keywords``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.operators import keywords as D
from colloquy.operators import lemmas as M
from colloquy.plans import fixtures as X
from colloquy.plans.registry import query, sql_lit as L
from colloquy.plans.tagger_queries import viterbi_sql

_STOPS_SQL = "[" + ", ".join(L(w) for w in D.FRENCH_STOP_WORDS) + "]"
_CORPUS_SQL = """SELECT (doc_id % 10) // 2 AS pair_id, doc_id % 2 AS side, doc_id,
    CASE WHEN (doc_id // 10) % 2 = 0 THEN 'response' ELSE 'question' END AS kind, text,
    count(*) OVER (PARTITION BY (doc_id % 10) // 2, doc_id % 2) AS n_texts
  FROM documents WHERE lang = 'fr'"""
_WORDS_SQL = rf"list_filter(regexp_extract_all(lower(text), '\p{{L}}+'), lambda x: NOT list_contains({_STOPS_SQL}, x))"


def table_sql(corpus: str) -> str:
    """Common table expressions up to ``s``: every word's score in the pairs of ``corpus``."""
    return f"""c AS ({corpus}),
cw AS (SELECT pair_id, side, doc_id, n_texts, {_WORDS_SQL} AS ws FROM c),
ct AS (SELECT pair_id, side, doc_id, array_to_string(ws, ', ') AS clean FROM cw),
n AS (SELECT DISTINCT pair_id, side, n_texts FROM c),
w AS (SELECT DISTINCT pair_id, side, unnest(ws) AS word FROM cw),
cnt AS (SELECT w.pair_id, w.side, w.word,
          count(*) FILTER (WHERE t.side = w.side) AS df_own,
          count(*) FILTER (WHERE t.side <> w.side) AS df_other
        FROM w JOIN ct t ON t.pair_id = w.pair_id AND contains(t.clean, w.word) GROUP BY ALL),
s AS (SELECT cnt.*, n1.n_texts AS n_own, n2.n_texts AS n_other,
        (df_own::DOUBLE / n1.n_texts) * ln(n2.n_texts::DOUBLE / (df_other + 1)) AS score
      FROM cnt JOIN n n1 ON n1.pair_id = cnt.pair_id AND n1.side = cnt.side
      JOIN n n2 ON n2.pair_id = cnt.pair_id AND n2.side <> cnt.side)"""


_TABLE_SQL = "WITH " + table_sql(_CORPUS_SQL)


def corpus(spark, sf_dir):
    d = X.documents(spark, sf_dir, "doc_id", "lang", "text").filter(F.col("lang") == "fr")
    d = d.withColumn("id", F.col("doc_id") % 10)
    pairs = d.select("id").distinct().select(
        (F.col("id") / 2).cast("bigint").alias("pair_id"), (F.col("id") % 2).alias("side"), "id")
    kind_even = ((F.col("doc_id") / 10).cast("bigint") % 2) == 0
    responses = d.filter(kind_even).select("id", "doc_id", "text")
    questions = d.filter(~kind_even).select("id", "doc_id", "text")
    return D.pair_corpus(pairs, responses, questions)


@query("d1_pair_corpus", "D1", f"SELECT pair_id, side, doc_id, kind, n_texts FROM ({_CORPUS_SQL})")
def d1(spark, sf_dir):
    return corpus(spark, sf_dir).select("pair_id", "side", "doc_id", "kind", "n_texts")


@query("d2_content_words", "D2", f"""
SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest({_WORDS_SQL}) AS word FROM documents WHERE lang = 'fr')
GROUP BY ALL""")
def d2(spark, sf_dir):
    d = X.documents(spark, sf_dir, "doc_id", "lang", "text").filter(F.col("lang") == "fr")
    w = D.content_words(d.select("doc_id", "text"), ["doc_id"])
    return w.groupBy("doc_id", "word").agg(F.count("*").alias("n"))


@query("d3_distinct_words", "D3", f"""
WITH c AS ({_CORPUS_SQL}) SELECT DISTINCT pair_id, side, unnest({_WORDS_SQL}) AS word FROM c""")
def d3(spark, sf_dir):
    c = corpus(spark, sf_dir)
    w = D.content_words(c.select("pair_id", "side", "text"), ["pair_id", "side"])
    return D.distinct_words(w, ["pair_id", "side"])


@query("d4_containment", "D4", f"{_TABLE_SQL} SELECT pair_id, side, word, df_own, df_other FROM s")
def d4(spark, sf_dir):
    return D.keyword_table(corpus(spark, sf_dir)).select("pair_id", "side", "word", "df_own", "df_other")


@query("d5_contrast_score", "D5", f"{_TABLE_SQL} SELECT pair_id, side, word, round(score, 6) AS score FROM s")
def d5(spark, sf_dir):
    t = D.keyword_table(corpus(spark, sf_dir))
    return t.select("pair_id", "side", "word", F.round("score", 6).alias("score"))


@query("d6_top_keyword", "D6", f"""{_TABLE_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY score DESC, word) AS rn FROM s)
SELECT pair_id, side, replace(translate(word, chr(146) || chr(128), '''€'), chr(156), 'oe') AS keyword,
  round(score, 6) AS score FROM r WHERE rn = 1""")
def d6(spark, sf_dir):
    best = D.top_keyword(D.keyword_table(corpus(spark, sf_dir)), ["pair_id", "side"])
    return best.withColumn("score", F.round("score", 6))


# D2 with lemmas: the lexicon is a stand-in read from the words of ``benchmark``: the lemma drops a
# final s, e or nt, the part of speech follows the ending, and words of four letters have two.
_LEX_SQL = r"""f AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS form FROM benchmark),
lx AS (SELECT form, regexp_replace(form, '(s|e|nt)$', '') AS lemma,
         CASE WHEN form LIKE '%nt' THEN 'VERB' WHEN form LIKE '%e' THEN 'ADJ' ELSE 'NOUN' END AS pos FROM f
       UNION SELECT form, form, 'VERB' FROM f WHERE length(form) = 4),
forms AS MATERIALIZED (SELECT form, pos, min(lemma) AS lemma FROM lx GROUP BY form, pos)"""
_TAG_NAMES = ["ADJ", "NOUN", "VERB"]
_TAGS_SQL = "(VALUES " + ", ".join(f"({n}, {L(t)})" for n, t in enumerate(_TAG_NAMES)) + ") AS tags(t, tag)"
_CANDIDATES_SQL = rf"""{_LEX_SQL},
sh AS (SELECT form, pos, lemma, list_max(list_filter(range(0, least(length(form), length(lemma)) + 1),
         lambda i: left(form, i::INTEGER) = left(lemma, i::INTEGER))) AS shared FROM forms),
ru AS (SELECT form, pos, length(form) - shared AS strip, substr(lemma, shared + 1) AS add FROM sh),
re AS (SELECT pos, strip, add, right(form, e::INTEGER) AS ending
       FROM ru, range(1, {M.ENDING} + 1) r(e) WHERE e >= strip AND e <= length(form)),
rc AS (SELECT ending, pos, strip, add, count(*) AS n FROM re GROUP BY ALL),
rb AS (SELECT * FROM rc QUALIFY row_number() OVER (PARTITION BY ending, pos ORDER BY n DESC, strip, add) = 1),
dw AS MATERIALIZED (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM (
  SELECT doc_id, regexp_extract_all(lower(text), '\p{{L}}+') AS ws FROM documents WHERE lang = 'fr')),
v AS (SELECT DISTINCT word FROM dw),
un AS (SELECT word, e, right(word, e::INTEGER) AS ending FROM v, range(1, {M.ENDING} + 1) r(e)
       WHERE e <= length(word) AND NOT EXISTS (SELECT 1 FROM forms WHERE form = word)),
me AS (SELECT * FROM un JOIN rb USING (ending) QUALIFY e = max(e) OVER (PARTITION BY word)),
cand AS MATERIALIZED (
  SELECT word, pos, lemma, 0::BIGINT AS weight FROM v JOIN forms ON form = word
  UNION ALL SELECT word, pos, left(word, (length(word) - strip)::INTEGER) || add,
    round(ln(n::DOUBLE / sum(n) OVER (PARTITION BY word)) * {M.MICRO})::BIGINT FROM me)"""


def lexicon(spark, sf_dir):
    words = X.benchmark(spark, sf_dir).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(D.WORD_PATTERN), 0)).alias("form"))
    form = F.col("form")
    pos = F.when(form.endswith("nt"), "VERB").when(form.endswith("e"), "ADJ").otherwise("NOUN")
    rows = words.distinct().select("form", F.regexp_replace("form", "(s|e|nt)$", "").alias("lemma"), pos.alias("pos"))
    return rows.unionByName(words.distinct().where(F.char_length("form") == 4).select(
        "form", form.alias("lemma"), F.lit("VERB").alias("pos")))


def _french(spark, sf_dir):
    d = X.documents(spark, sf_dir, "doc_id", "lang", "text")
    return d.filter(F.col("lang") == "fr").select("doc_id", "text")


@query("d2_guessed_lemmas", "D2", f"WITH {_CANDIDATES_SQL} SELECT word, pos, lemma, weight FROM cand")
def d2_lemmas(spark, sf_dir):
    docs = _french(spark, sf_dir)
    model = M.fit_lemmas(lexicon(spark, sf_dir), docs)
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(D.WORD_PATTERN), 0)).alias("word"))
    return M.candidates(words, model.forms, model.endings)


@query("d2_tagged_words", "D2", f"""WITH RECURSIVE {_CANDIDATES_SQL},
one AS (SELECT form, min(pos) AS tag FROM forms GROUP BY form HAVING count(*) = 1),
nb AS (SELECT lag(word) OVER (PARTITION BY doc_id ORDER BY pos) AS a, pos, word AS b FROM dw),
nc AS (SELECT CASE WHEN nb.pos = 0 THEN '^' ELSE x.tag END AS p, y.tag AS t, count(*) AS n
       FROM nb JOIN one y ON y.form = nb.b LEFT JOIN one x ON x.form = nb.a WHERE nb.pos = 0 OR x.tag IS NOT NULL GROUP BY ALL),
z_a AS MATERIALIZED (SELECT pt.t AS p, tags.t, round({M.MICRO} * ln((coalesce(n, 0) + 1)::DOUBLE
         / (sum(coalesce(n, 0)) OVER (PARTITION BY pt.t) + {len(_TAG_NAMES)})))::BIGINT AS a
       FROM (SELECT t, tag FROM {_TAGS_SQL} UNION ALL SELECT -1, '^') pt CROSS JOIN {_TAGS_SQL}
       LEFT JOIN nc ON nc.p = pt.tag AND nc.t = tags.tag),
seq AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY doc_id, pos // {M.PART}) AS s, pos % {M.PART} AS i FROM dw),
z_e AS MATERIALIZED (SELECT s, i, tags.t, CASE WHEN k.word IS NULL THEN 0 ELSE coalesce(cand.weight, {M.NEVER}) END AS e
       FROM seq CROSS JOIN {_TAGS_SQL} LEFT JOIN (SELECT DISTINCT word FROM cand) k ON k.word = seq.word
       LEFT JOIN cand ON cand.word = seq.word AND cand.pos = tags.tag),{viterbi_sql("z", _TAGS_SQL)}
SELECT doc_id, coalesce(cand.lemma, seq.word) AS lemma, z.tag, count(*) AS n
FROM seq JOIN z ON z.s = seq.s AND z.i = seq.i LEFT JOIN cand ON cand.word = seq.word AND cand.pos = z.tag GROUP BY ALL""")
def d2_tagged(spark, sf_dir):
    docs = _french(spark, sf_dir)
    tagged = M.tag_words(docs, M.fit_lemmas(lexicon(spark, sf_dir), docs), ["doc_id"])
    return tagged.groupBy("doc_id", "lemma", "tag").agg(F.count(F.lit(1)).alias("n"))
