"""Operator 5: language ID by word-first backoff.

Method: a word that the model knows scores its log frequency in each language;
a word it has not seen falls back to its character n-grams, from ``MAX_GRAM``
letters down: at each position the longest known n-gram counts. (A cost per step down
would be the same for every language, so there is none.) The scores of all words of a
text add up.

The model is fitted on a bounded sample: about ``FIT_ROWS`` labelled rows that are
not held out, or fewer if those hold more than about ``FIT_CHARS`` code points, chosen by
a hash of their text (a sample of all rows, wherever they lie). Every word and n-gram of
the sample is kept; the sample's bound is the bound of what is sent to the executors.
Prediction reads every whole text.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is any text if there is nothing to learn from; ties go to the first language
by name; repeated rows are predicted alike; a null doc_id is held out; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import held_out, in_share
from colloquy.session import materialize, read_table

FIT_ROWS, FIT_CHARS, MAX_GRAM = 8_000, 32_000_000, 4
RUN = re.compile(r"[^\W\d_]+")
REJECT_BELOW = 0.5


def words_of(text: str) -> list[str]:
    """Lower-cased letter runs; digits of other kinds (superscripts, fractions) part them."""
    if not text:
        return []
    runs = RUN.findall(text.lower())
    if all(map(str.isalpha, runs)):
        return runs
    return [w for r in runs for w in (
        [r] if r.isalpha() else "".join(c if c.isalpha() else " " for c in r).split())]


@dataclass
class Model:
    """The words and n-grams are kept as columns; a task looks them up in dictionaries of its own."""

    langs: list[str]
    word_items: pa.Array
    word_log: np.ndarray  # word x language
    gram_items: pa.Array
    gram_log: np.ndarray

    @cached_property
    def words(self) -> dict[str, int]:
        return {w: i for i, w in enumerate(self.word_items.to_pylist())}

    @cached_property
    def grams(self) -> dict[str, int]:
        return {g: i for i, g in enumerate(self.gram_items.to_pylist())}

    def unseen(self, word: str) -> list[int]:
        """The n-grams that stand for a word: the longest known one at each letter."""
        padded, out = f"^{word}$", []
        for i in range(len(padded)):
            for n in range(min(MAX_GRAM, len(padded) - i), 0, -1):
                at = self.grams.get(padded[i:i + n])
                if at is not None:
                    out.append(at)
                    break
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.langs:
            return "und", 0.0
        known, known_n, grams, gram_n = [], [], [], []
        for w, n in Counter(words).items():
            at = self.words.get(w)
            if at is not None:
                known.append(at)
                known_n.append(n)
            else:
                ids = self.unseen(w)
                grams += ids
                gram_n += [n / max(1, len(ids))] * len(ids)
        total = np.zeros(len(self.langs))
        if known:
            total += np.array(known_n, float) @ self.word_log[known]
        if grams:
            total += np.array(gram_n, float) @ self.gram_log[grams]
        best = int(total.argmax())
        # evidence grows with the root of the length: words of a text are not independent
        odds = np.exp((total - total[best]) / math.sqrt(len(words)))
        return self.langs[best], float(1 / odds.sum())


def _log_table(table: DataFrame, langs: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The items of (item, lang, n) rows, and their add-half smoothed log frequency per language."""
    if not langs:
        return pa.array([], pa.string()), np.empty((0, 0))
    wide = table.groupBy("item").agg(*[
        F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, x in enumerate(langs)])
    got = wide.toArrow().combine_chunks()  # as many rows as the sample has items
    if not got.num_rows:
        return pa.array([], pa.string()), np.empty((0, len(langs)))
    counts = np.stack([got[f"n{i}"].to_numpy() for i in range(len(langs))], axis=1) + 0.5
    return got["item"].combine_chunks(), np.log(counts / counts.sum(axis=0))


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS, fit_chars: int = FIT_CHARS) -> Model:
    lang, text = docs["lang"].cast("string"), docs["text"].cast("string")
    usable = ~held_out(docs["doc_id"]) & lang.isNotNull() & docs["text"].isNotNull()
    n, chars = docs.where(usable).agg(F.count(F.lit(1)), F.sum(F.char_length(text))).first()
    wanted = min(fit_rows, max(1, n * fit_chars // max(1, chars or 0)))
    sample = docs.where(usable).select(text.alias("text"), lang.alias("lang")).where(
        in_share(F.xxhash64("text"), wanted, n))

    def count(batches):
        for pdf in batches:
            by = defaultdict(Counter)
            for t, la in zip(pdf["text"], pdf["lang"]):
                by[la].update(words_of(t))
            yield pd.DataFrame([(w, la, n) for la, ws in by.items() for w, n in ws.items()],
                               columns=["item", "lang", "n"])

    words = materialize(sample.mapInPandas(count, "item string, lang string, n long")
                        .groupBy("item", "lang").agg(F.sum("n").alias("n")), "lang_words")
    langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())  # labels of the sample

    def spell(batches):
        for pdf in batches:
            by = Counter()
            for w, la, n in zip(pdf["item"], pdf["lang"], pdf["n"]):
                p = f"^{w}$"
                for k in range(1, MAX_GRAM + 1):
                    for i in range(len(p) - k + 1):
                        by[p[i:i + k], la] += n
            yield pd.DataFrame([(g, la, n) for (g, la), n in by.items()], columns=["item", "lang", "n"])

    spelled = words.mapInPandas(spell, "item string, lang string, n long").groupBy("item", "lang").agg(
        F.sum("n").alias("n"))

    return Model(langs, *_log_table(words, langs), *_log_table(spelled, langs))


def predictor(spark: SparkSession, model: Model):
    """Column function text -> struct<lang_pred, score>."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m = sent.value
        return pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    predict = predictor(docs.sparkSession, model)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"),
                       predict(docs["text"].cast("string")).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, model: Model, reject_below: float = REJECT_BELOW) -> DataFrame:
    """The documents with a language: not ``und`` and a score of ``reject_below`` or more."""
    p = predictor(docs.sparkSession, model)(docs["text"].cast("string"))
    return docs.where((p["lang_pred"] != "und") & (p["score"] >= reject_below))


def op5(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
