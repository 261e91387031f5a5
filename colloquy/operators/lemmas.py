"""Lemmas and parts of speech from a lexicon, for the words it does not hold as well.

A lexicon is rows (form, lemma, pos); a form may have several. From its rows are learned

* ending rules: what a form loses and its lemma gains at the end, kept for every ending of up
  to ``ENDING`` letters that holds the loss, per part of speech the most frequent rule (then the
  shorter loss, then the gain). A form that the lexicon lacks takes the rules of its longest
  known ending;
* a bigram model of tags: counts of neighbouring words of the texts that have one part of speech
  each, add-one smoothed.

Each text's tags are decoded by Viterbi's recursion (``tagger.viterbi``) over parts of ``PART``
words, and a word's lemma is that of its tag. A word without a known ending may have any tag and
is its own lemma. Words are lower-cased letter runs. All scores are whole millionths of
logarithms, so that sums are exact. The lexicon and its rules stay distributed tables; the
driver holds the tags and their transitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.operators.keywords import FRENCH_STOP_WORDS, WORD_PATTERN
from colloquy.operators.tagger import viterbi
from colloquy.session import materialize

ENDING, PART, MICRO, NEVER = 6, 512, 1_000_000, -10**15
START = "^"


@dataclass(frozen=True)
class LemmaModel:
    """``forms(form, pos, lemma)``, ``endings(ending, pos, strip, add, n)``, the tags in order and
    ``trans[p][t]`` of tag t after tag p (the last row: at the start)."""

    forms: DataFrame
    endings: DataFrame
    tags: list[str]
    trans: list[list[int]]


def ending_rules(forms: DataFrame) -> DataFrame:
    """(ending, pos, strip, add, n): per ending and part of speech the most frequent rule."""
    short = F.least(F.char_length("form"), F.char_length("lemma"))
    shared = F.size(F.filter(F.sequence(F.lit(0), short), lambda i: F.substr("form", F.lit(1), i) == F.substr("lemma", F.lit(1), i))) - 1
    cut = forms.withColumn("shared", shared).select(
        "form", "pos", (F.char_length("form") - F.col("shared")).alias("strip"),
        F.expr("substring(lemma, shared + 1)").alias("add"))
    least, most = F.greatest("strip", F.lit(1)), F.least(F.char_length("form"), F.lit(ENDING))
    each = cut.where(least <= most).select(
        F.explode(F.sequence(least, most)).alias("e"), "form", "pos", "strip", "add").select(
        F.right("form", F.col("e")).alias("ending"), "pos", "strip", "add")
    counts = each.groupBy("ending", "pos", "strip", "add").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.struct("strip", "add", "n"), F.struct(-F.col("n"), "strip", "add"))
    return counts.groupBy("ending", "pos").agg(best.alias("b")).select("ending", "pos", "b.strip", "b.add", "b.n")


def candidates(words: DataFrame, forms: DataFrame, endings: DataFrame) -> DataFrame:
    """(word, pos, lemma, weight): what each distinct ``word`` may be. The lexicon's own readings
    weigh alike; those by an ending by the share of its rules."""
    words = words.select("word").distinct()
    known = words.join(forms.withColumnRenamed("form", "word"), "word").select(
        "word", "pos", "lemma", F.lit(0).cast("long").alias("weight"))
    unseen = words.join(forms.select(F.col("form").alias("word")).distinct(), "word", "left_anti")
    ends = unseen.select("word", F.explode(F.sequence(F.lit(1), F.least(F.char_length("word"), F.lit(ENDING)))).alias("e")).select(
        "word", "e", F.right("word", F.col("e")).alias("ending"))
    met = ends.join(endings, "ending").groupBy("word").agg(F.max_by(  # one ending's rules: one per part of speech
        F.struct("e"), "e").alias("longest"), F.collect_list(F.struct("e", "pos", "strip", "add", "n")).alias("r"))
    rules = met.withColumn("r", F.filter("r", lambda x: x["e"] == F.col("longest.e")))
    rules = rules.withColumn("all", F.aggregate("r", F.lit(0).cast("long"), lambda s, x: s + x["n"])).select(
        "word", "all", F.explode("r").alias("r"))
    guessed = rules.select("word", "r.pos", F.concat(F.expr("substring(word, 1, char_length(word) - r.strip)"), "r.add").alias("lemma"),
                           F.round(F.log(F.col("r.n") / F.col("all")) * MICRO).cast("long").alias("weight"))
    return known.unionByName(guessed)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), 0)


def transitions(texts: DataFrame, text: str, forms: DataFrame, tags: list[str]) -> list[list[int]]:
    """Smoothed log frequencies of neighbouring tags, from words with one part of speech each."""
    pairs = texts.select(_words(F.col(text)).alias("w")).select(F.explode(F.transform("w", lambda x, i: F.struct(
        F.when(i > 0, F.get("w", i - 1)).otherwise("").alias("a"), x.alias("b")))).alias("x")).groupBy("x.a", "x.b").count()
    single = forms.groupBy("form").agg(F.min("pos").alias("pos"), F.count(F.lit(1)).alias("n")).where("n = 1").select("form", "pos")
    start = forms.sparkSession.createDataFrame([("", START)], "form string, pos string")
    before = single.unionByName(start).toDF("a", "p")
    counts = pairs.join(before, "a").join(single.toDF("b", "t"), "b").groupBy("p", "t").agg(F.sum("count").alias("n"))
    seen = {(r["p"], r["t"]): r["n"] for r in counts.collect()}  # at most (tags + 1) x tags rows
    out = []
    for p in [*tags, START]:
        whole = sum(seen.get((p, t), 0) for t in tags) + len(tags)
        out.append([round(MICRO * math.log((seen.get((p, t), 0) + 1) / whole)) for t in tags])
    return out


def fit_lemmas(lexicon: DataFrame, texts: DataFrame, text: str = "text") -> LemmaModel:
    """Learn from ``lexicon(form, lemma, pos)`` and the texts' own neighbourhoods. Rows with a null
    or an empty form are left out; a null lemma is the form; a (form, pos) has one lemma, the least."""
    rows = lexicon.where("form <> '' and pos is not null").groupBy(F.lower("form").alias("form"), "pos").agg(
        F.min(F.lower(F.coalesce("lemma", "form"))).alias("lemma"))
    forms = materialize(rows, "lemma-forms")
    tags = sorted(r["pos"] for r in forms.select("pos").distinct().collect())  # the parts of speech
    return LemmaModel(forms, materialize(ending_rules(forms), "lemma-endings"), tags, transitions(texts, text, forms, tags))


def content_lemmas(df: DataFrame, model: LemmaModel, keys: Sequence[str], text: str = "text",
                   stop_words: Sequence[str] = FRENCH_STOP_WORDS, keep_pos: Sequence[str] | None = None) -> DataFrame:
    """D2 with a model: rows (keys, pos, word) of the lemmas of all words that are no stop words and,
    with ``keep_pos``, have one of those parts of speech in their text's decoding."""
    out = tag_words(df, model, keys, text).where(~F.col("word").isin(list(stop_words)))
    if keep_pos is not None:
        out = out.where(F.col("tag").isin(list(keep_pos)))
    return out.select(*keys, "pos", F.col("lemma").alias("word"))


def tag_words(df: DataFrame, model: LemmaModel, keys: Sequence[str], text: str = "text") -> DataFrame:
    """(keys, pos, word, lemma, tag) of every word; ``pos`` is its position among the text's words."""
    tags = model.tags
    parts = df.select(*keys, _words(F.col(text)).alias("w")).where(F.size("w") > 0).select(
        *keys, "w", F.explode(F.expr(f"sequence(0, size(w) - 1, {PART})")).alias("at")).select(
        *keys, "at", F.expr(f"slice(w, at + 1, {PART})").alias("w"))
    # written, so that the numbers stay the same when a task is repeated
    parts = materialize(parts.withColumn("_s", F.monotonically_increasing_id()), "lemma-parts")
    each = parts.select("_s", F.posexplode("w").alias("i", "word"))

    def by_tag(c, missing):
        return F.array(*[F.coalesce(F.max(F.when(F.col("pos") == t, F.col(c))), missing) for t in tags])

    may = candidates(each, model.forms, model.endings).groupBy("word").agg(
        by_tag("weight", F.lit(NEVER)).alias("s"), by_tag("lemma", F.lit(None).cast("string")).alias("lemmas"))
    any_tag = F.array(*[F.lit(0).cast("long") for _ in tags])
    read = each.join(may, "word", "left").groupBy("_s").agg(F.array_sort(F.collect_list(F.struct(  # at most PART
        "i", "word", F.coalesce("s", any_tag).alias("s"), F.coalesce("lemmas", F.array()).alias("lemmas")))).alias("x"))
    path = read.select("_s", "x", viterbi(F.col("x.s"), model.trans).alias("path")) if tags else \
        read.select("_s", "x", F.transform("x", lambda _: F.lit(-1)).alias("path"))
    out = path.select("_s", F.explode(F.arrays_zip("x", "path")).alias("z"))
    names = F.array(*map(F.lit, tags)) if tags else F.array().cast("array<string>")
    found = out.select("_s", "z.x.i", "z.x.word", F.coalesce(F.get("z.x.lemmas", F.col("z.path")), "z.x.word").alias("lemma"),
                       F.get(names, F.col("z.path")).alias("tag"))
    return found.join(parts.select("_s", *keys, "at"), "_s").select(
        *keys, (F.col("at") + F.col("i")).alias("pos"), "word", "lemma", "tag")
