"""Corpus-assembly queries (H1-H5) over ``documents``: an intent is a
document ``source``, its examples are the documents' texts; the language
says which list a document belongs to."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from colloquy.operators import corpus as H
from colloquy.plans import fixtures as X
from colloquy.plans.registry import query

_REPAIR_SQL = "replace(translate(text, chr(146) || chr(128) || chr(160), '''€ '), chr(156), 'oe')"


def _docs(spark, sf_dir):
    return X.documents(spark, sf_dir, "doc_id", "source", "lang")


def _by_language(docs):
    """One list per language of the table, by name; the documents without one are the last."""
    langs = sorted((r["lang"] for r in docs.select("lang").distinct().collect()), key=lambda x: (x is None, x))
    return [docs.where(F.col("lang").eqNullSafe(F.lit(x))) for x in langs]


# H1: the lists of all languages, one after another.
@query("h1_merge_lists", "H1", "SELECT lang AS origin, source AS name, doc_id FROM documents")
def h1(spark, sf_dir):
    lists = [d.select(F.col("lang").alias("origin"), F.col("source").alias("name"), "doc_id")
             for d in _by_language(_docs(spark, sf_dir))]
    return functools.reduce(H.merge_lists, lists)


# H2 languages in priority order: a key is a source and the last two digits of its
# document, so keys are met in several languages; a later one replaces a key's whole list.
@query("h2_merge_by_priority", "H2", """
WITH s AS (SELECT source || '/' || (doc_id % 100)::VARCHAR AS key, doc_id, lang,
             dense_rank() OVER (ORDER BY lang NULLS LAST)::INTEGER AS priority FROM documents),
b AS (SELECT key, max(priority) AS priority FROM s GROUP BY key)
SELECT s.key, s.doc_id, s.lang, s.priority FROM s JOIN b USING (key, priority)""")
def h2(spark, sf_dir):
    d = _docs(spark, sf_dir)
    key = F.concat_ws("/", "source", (F.col("doc_id") % 100).cast("string"))
    d = d.select(key.alias("key"), "doc_id", "lang")
    out = H.merge_by_priority(_by_language(d), "key")
    return out.select("key", "doc_id", "lang", "priority")


# H3: texts of even documents, augmented by those of odd ones; an intent is a
# source and language.
@query("h3_augment_examples", "H3", f"""
WITH d AS (SELECT source || '/' || lang AS intent, doc_id, text FROM documents),
a AS (SELECT * FROM d WHERE doc_id % 2 = 0), b AS (SELECT * FROM d WHERE doc_id % 2 = 1),
k AS (SELECT DISTINCT intent FROM a)
SELECT u.intent, u.doc_id, u.part, CASE WHEN k.intent IS NOT NULL THEN 1 ELSE 2 END AS intent_order,
  {_REPAIR_SQL.replace('text', 'u.text')} AS text
FROM (SELECT *, 1 AS part FROM a UNION ALL SELECT *, 2 FROM b) u LEFT JOIN k USING (intent)""")
def h3(spark, sf_dir):
    d = X.documents(spark, sf_dir, "doc_id", "source", "lang", "text")
    d = d.select(F.concat_ws("/", "source", "lang").alias("intent"), "doc_id", "text")
    a, b = d.filter(F.col("doc_id") % 2 == 0), d.filter(F.col("doc_id") % 2 == 1)
    return H.augment_examples(a, b, "intent").select("intent", "doc_id", "part", "intent_order", "text")


@query("h4_vocabulary", "H4", r"""
SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents""")
def h4(spark, sf_dir):
    d = X.documents(spark, sf_dir, "text")
    words = d.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0)).alias("word"))
    return H.vocabulary(words, "word")


@query("h5_group_count", "H5", "SELECT source, count(*) AS n_texts FROM documents GROUP BY source")
def h5(spark, sf_dir):
    return H.group_count(_docs(spark, sf_dir), "source")


@query("h5_distinct_ids", "H5", "SELECT count(DISTINCT source) AS n_ids FROM documents")
def h5_ids(spark, sf_dir):
    return H.distinct_ids(_docs(spark, sf_dir), "source")
