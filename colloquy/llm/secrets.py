"""Operator 6: secret scan (DataFrame functions only on the main path).

Method: trigram inverted index. Each rule's regex gives a Boolean trigram query:
an AND of groups, each an OR of literals, each the AND of a literal's trigrams
(:func:`trigram_query`). The index holds, for every trigram that some rule
asks for, the postings (trigram, doc_id) over lower-cased whole texts, and is
written to the shared folder. Rules are answered by joining the postings with
the query terms and counting: a document that has all trigrams of a literal
passes its group, one that passes all groups of a rule is a candidate. Only
candidates are verified with the regex itself. A rule without mandatory
trigrams (``hex``) scans every text.

Positions are code points: ``split`` gives the stretches between the matches of
``regexp_extract_all``, and the running lengths of both give start and end.

Defined results: a null text is empty; a null doc_id is kept as null; rows that
share a doc_id share candidates, which only costs a verification; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re._constants as c
import re._parser as parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import id_text
from colloquy.session import materialize, read_table


@dataclass(frozen=True)
class Rule:
    """``pattern`` must mean the same to Java and to RE2. A match counts if
    ``group`` (0: all of it) has at least ``least`` characters. Where a search for
    ``pattern`` may read a stretch of text from each of many starts, ``once`` is a Java
    regex that takes every run of its letters whole, match or not, and has the matches of
    ``pattern`` as its group 1, at the end of what it takes."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0
    once: str = ""


#: fixed values: the three base rules first, in the order of their columns
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
         once=r"(?=[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8})[A-Za-z0-9_-]*?"
              r"(eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)|[A-Za-z0-9_-]++"),
)
BASE = 3
MAX_LITERALS = 32  # more alternatives than this end a literal run (the query stays correct, only weaker)


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """AND of groups, each an OR of trigram sets, that every text with a match
    passes once lower-cased. Empty: the regex has no mandatory trigram."""
    groups: list[list[frozenset[str]]] = []

    def close(run: set[str]) -> set[str]:
        if all(len(x) >= 3 for x in run):
            groups.append(sorted({frozenset(x[i:i + 3] for i in range(len(x) - 2)) for x in run}, key=sorted))
        return {""}

    def literals(node) -> set[str] | None:
        """The few strings that a node stands for, or None."""
        kind, arg = node
        if kind is c.LITERAL:
            return {chr(arg).lower()}
        if kind is c.IN and all(x[0] is c.LITERAL for x in arg):
            return {chr(x[1]).lower() for x in arg}
        if kind is c.SUBPATTERN:
            return series(arg[-1])
        if kind is c.BRANCH:
            found = [series(x) for x in arg[1]]
            return None if None in found else set().union(*found)
        if kind is c.MAX_REPEAT and arg[:2] == (0, 1):
            one = series(arg[2])
            return None if one is None else one | {""}
        if kind is c.MAX_REPEAT and arg[0] == arg[1] and arg[0] <= 8:
            return series(list(arg[2]) * arg[0])
        return None

    def series(nodes) -> set[str] | None:
        out = {""}
        for node in nodes:
            one = literals(node)
            if one is None or len(out) * len(one) > MAX_LITERALS:
                return None
            out = {a + b for a in out for b in one}
        return out

    run = {""}
    for node in parser.parse(pattern):
        one = literals(node)
        if one is not None and len(one) <= MAX_LITERALS:
            if len(run) * len(one) > MAX_LITERALS:
                run = close(run)
            run = {a + b for a in run for b in one}
        else:
            run = close(run)
    close(run)
    return groups


def build_index(docs: DataFrame, rules=RULES) -> DataFrame:
    """Postings (trigram, doc_id) of the trigrams that the rules ask for."""
    asked = sorted({t for r in rules for g in trigram_query(r.pattern) for alt in g for t in alt})
    low = id_text(docs).select("doc_id", F.lower("text").alias("low"))
    has = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in asked]))
    return materialize(low.select(F.explode(has).alias("trigram"), "doc_id"), "trigram_index")


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, rules): the rules whose trigram query a document passes. Counting
    is combined map-side; a literal counts as found once all its trigrams are."""
    terms = [(r.name, g, a, t, len(alt)) for r in rules for g, alts in enumerate(trigram_query(r.pattern))
             for a, alt in enumerate(alts) for t in sorted(alt)]
    needs = [(r.name, len(trigram_query(r.pattern))) for r in rules]
    spark = index.sparkSession
    terms = spark.createDataFrame(terms, "rule string, grp int, alt int, trigram string, need int")
    needs = spark.createDataFrame(needs, "rule string, groups int")
    found = (index.join(F.broadcast(terms), "trigram")  # the rule set's own size
             .groupBy("doc_id", "rule", "grp", "alt", "need").agg(F.count(F.lit(1)).alias("n")).where("n >= need"))
    passed = found.groupBy("doc_id", "rule").agg(F.count_distinct("grp").alias("groups"))
    return (passed.join(F.broadcast(needs), ["rule", "groups"])
            .groupBy("doc_id").agg(F.collect_set("rule").alias("rules")))


def _spans(text: Column, r: Rule, order: int) -> Column:
    """Spans of one rule as array<struct<s, k, e, kind>>."""
    pattern, group, least = (r.once, 1, 1) if r.once else (r.pattern, r.group, r.least)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"), checked.alias("part"))
    zipped = F.slice(zipped, 1, F.size(found))
    empty = F.array().cast("array<struct<s:int,k:int,e:int,kind:string>>")

    def step(acc, x):
        s = acc["pos"] + F.char_length(x["gap"])
        e = s + F.char_length(x["hit"])
        start = e - F.char_length(x["part"]) if r.once else s
        span = F.struct(start.alias("s"), F.lit(order).alias("k"), e.alias("e"), F.lit(r.name).alias("kind"))
        return F.struct(e.alias("pos"), F.when(F.char_length(x["part"]) >= least, F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    spans = F.aggregate(zipped, F.struct(F.lit(0).alias("pos"), empty.alias("out")), step, lambda acc: acc["out"])
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(empty)


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``docs``: doc_id and, per rule, its spans (array column named after it)."""
    hits = candidates(build_index(docs, rules), rules).withColumnRenamed("doc_id", "_id")
    slim = id_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = slim.join(hits, slim["doc_id"].eqNullSafe(hits["_id"]), "left")
    empty = F.array().cast("array<struct<s:int,k:int,e:int,kind:string>>")
    cols = []
    for k, r in enumerate(rules):
        spans = _spans(F.col("text"), r, k)
        if trigram_query(r.pattern):
            spans = F.when(F.array_contains("rules", r.name), spans).otherwise(empty)
        cols.append(spans.alias(r.name))
    return both.select("doc_id", *cols)


def op6(spark, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents"))
    base = F.concat(*[F.col(r.name) for r in RULES[:BASE]])
    every = F.concat(*[F.col(r.name) for r in RULES])
    return found.select(
        "doc_id", *[F.size(r.name).cast("long").alias(f"n_{r.name}") for r in RULES[:BASE]],
        F.sha2(_digest(base), 256).alias("base_sha256"), _digest(every).alias("spans"))


def _sql_spans(r: Rule, order: int) -> str:
    pat = r.pattern.replace("'", "''")
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{pat}')) + 1), lambda i: {{
      's': list_sum(list_transform(string_split_regex(t, '{pat}')[1:i], lambda x: length(x)))::BIGINT
           + coalesce(list_sum(list_transform(regexp_extract_all(t, '{pat}')[1:i - 1], lambda x: length(x))), 0)::BIGINT,
      'k': {order}, 'n': length(regexp_extract_all(t, '{pat}')[i]), 'kind': '{r.name}',
      'part': length(regexp_extract_all(t, '{pat}', {r.group})[i])}}), lambda x: x.part >= {r.least})"""


def _sql_join(cols: list[str]) -> str:
    return (f"array_to_string(list_transform(list_sort({reduce(lambda a, b: f'list_concat({a}, {b})', cols)}), "
            "lambda x: x.kind || ':' || x.s || ':' || (x.s + x.n)), ',')")


OP6_SQL = f"""
WITH found AS (
  SELECT doc_id, {', '.join(f'{_sql_spans(r, k)} AS c_{r.name}' for k, r in enumerate(RULES))}
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
SELECT doc_id, {', '.join(f'len(c_{r.name})::BIGINT AS n_{r.name}' for r in RULES[:BASE])},
       sha256({_sql_join([f'c_{r.name}' for r in RULES[:BASE]])}) AS base_sha256,
       {_sql_join([f'c_{r.name}' for r in RULES])} AS spans
FROM found
"""
