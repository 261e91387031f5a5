"""C4, trained: a response selector that learns which words of questions go with which words of
responses, so that a question finds its response without sharing words with it.

Questions and responses of one id are told apart by their side. Every (side, word) has a row
and every id a column of a count matrix; alternating least squares (``pyspark.ml``, implicit
counts) gives them places in a space of ``rank`` dimensions, where words of both sides lie near
the ids they stand for. A text is the idf-weighted sum of its words' places, scaled to length
one, and responses are ranked by the cosine, exactly, through pivots
(``neighbours.dense_neighbours``). Words never seen with their side have no place; a text
without a known word matches nothing.

Word and id numbers are dealt by hashed buckets (no word list on the driver). Null ids and texts
teach nothing. Training is repeatable for a fixed seed and partitioning, up to rounding.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.operators.intents import WORD_RE
from colloquy.operators.neighbours import dense_neighbours
from colloquy.session import materialize

RANK, ROUNDS, ALPHA, REG, SEED, BUCKETS = 24, 10, 20.0, 0.05, 42, 256
QUESTION, RESPONSE = "q", "r"


@dataclass(frozen=True)
class Selector:
    """``words(side, word, place, idf)``: every known word's place in the space."""

    words: DataFrame


def numbered(values: DataFrame, column: str) -> DataFrame:
    """Distinct values with gapless numbers ``n``: ranked inside hashed buckets, plus the
    buckets before."""
    rows = values.select(column).distinct().withColumn("_b", F.pmod(F.xxhash64(column), F.lit(BUCKETS)))
    sizes = rows.groupBy("_b").count()  # at most BUCKETS rows
    before = sizes.select("_b", (F.sum("count").over(Window.orderBy("_b")) - F.col("count")).alias("_before"))
    at = F.row_number().over(Window.partitionBy("_b").orderBy(column)) - 1
    return rows.withColumn("_at", at).join(before, "_b").select(column, (F.col("_before") + F.col("_at")).cast("int").alias("n"))


def _words(texts: DataFrame, side: str, keys: Sequence[str], text: str) -> DataFrame:
    return texts.select(*keys, F.lit(side).alias("side"), F.explode(F.regexp_extract_all(
        F.lower(F.col(text)), F.lit(WORD_RE), 0)).alias("word"))


def fit_selector(questions: DataFrame, responses: DataFrame, id_col: str = "id", text: str = "text", rank: int = RANK,
                 rounds: int = ROUNDS, seed: int = SEED) -> Selector:
    """Learn from ``questions(id, text)`` and ``responses(id, text)``."""
    from pyspark.ml.recommendation import ALS

    said = _words(questions, QUESTION, [id_col], text).unionByName(_words(responses, RESPONSE, [id_col], text))
    counts = said.where(F.col(id_col).isNotNull()).groupBy("side", "word", id_col).agg(F.count(F.lit(1)).alias("c"))
    counts = materialize(counts.withColumn("row", F.concat_ws(":", "side", "word")), "selector-counts")
    ids = counts.select(id_col).distinct().count()  # one number
    rows = materialize(numbered(counts, "row"), "selector-rows")
    cols = numbered(counts, id_col).withColumnRenamed("n", "col")
    # a word of every id says nothing; the rarer it is, the more it weighs
    idf = counts.groupBy("row").agg(F.log((F.lit(ids) + 1.0) / F.count(F.lit(1))).alias("idf"))
    cells = counts.join(rows, "row").join(cols, id_col).join(idf, "row").select(
        F.col("n").alias("word"), "col", (F.log1p("c") * F.col("idf")).cast("float").alias("weight"))
    als = ALS(rank=rank, maxIter=rounds, regParam=REG, alpha=ALPHA, implicitPrefs=True, nonnegative=False, seed=seed,
              userCol="word", itemCol="col", ratingCol="weight", coldStartStrategy="drop")
    places = als.fit(materialize(cells, "selector-cells")).userFactors.select(F.col("id").alias("n"), F.col("features").alias("place"))
    known = counts.select("row", "side", "word").distinct().join(rows, "row").join(places, "n").join(idf, "row")
    return Selector(materialize(known.select("side", "word", "place", "idf"), "selector-words"))


def text_places(texts: DataFrame, selector: Selector, side: str, key: str, text: str = "text") -> DataFrame:
    """(key, place) of every text with a known word. Keys must be unique."""
    size = selector.words.agg(F.max(F.size("place"))).first()[0] or 0
    tf = _words(texts, side, [key], text).groupBy(key, "side", "word").agg(F.count(F.lit(1)).alias("tf"))
    met = tf.join(selector.words, ["side", "word"])
    weight = F.log1p("tf") * F.col("idf")
    # every place has the space's dimensions: a sum per dimension, combined map-side
    return met.groupBy(key).agg(F.array(*[F.sum(weight * F.get("place", F.lit(i))) for i in range(size)]).alias("place"))


def select_responses(queries: DataFrame, responses: DataFrame, selector: Selector, k: int = 3, q_key: str = "query",
                     key: str = "item_id", text: str = "text") -> DataFrame:
    """C4: (q_key, rank, key, cosine) of the k responses nearest to each query in the learned space."""
    asked = text_places(queries, selector, QUESTION, q_key, text).select(F.col(q_key).alias("_q"), "place")
    bank = text_places(responses, selector, RESPONSE, key, text).select(F.col(key).alias("_q"), "place", F.lit(0).alias("label"))
    # keys of both sides are told apart, so that a query is not taken for a response of its number
    asked = asked.withColumn("_q", F.concat(F.lit(QUESTION), F.col("_q").cast("string")))
    near = dense_neighbours(asked, bank.withColumn("own", F.col("_q")).withColumn(
        "_q", F.concat(F.lit(RESPONSE), F.lpad(F.col("_q").cast("string"), 20, "0"))), k, "place", "_q", "label")
    back = bank.select(F.concat(F.lit(RESPONSE), F.lpad(F.col("_q").cast("string"), 20, "0")).alias("_q"), F.col("_q").alias(key))
    number = queries.select(F.concat(F.lit(QUESTION), F.col(q_key).cast("string")).alias("query_"), q_key)
    return near.withColumnRenamed("query", "query_").join(number, "query_").join(back, "_q").select(q_key, "rank", key, "cosine")
