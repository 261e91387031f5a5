"""Contrastive keywords (D1-D6): the word that best separates the two
intents of a confused pair.

Substring containment ("in how many cleaned texts does this word occur")
is computed exactly without comparing every word with every text:

* words are runs of letters, and a cleaned text is its words joined by a
  separator, so a word occurs in a cleaned text iff it is a substring of one
  of the text's words;
* containment is first solved on the *vocabulary* of each pair: every
  distinct token is indexed by the first 1..6 letters of each of its
  suffixes; a word of at most 6 letters is looked up by itself (every match
  is a hit), a longer word by its first 6 letters, and those candidates are
  verified with ``contains``;
* a token's words are joined to the texts it occurs in, merged per text and counted.

Every step is an equi-join or a grouped aggregate, so the work grows with
the vocabulary's letters and the true hits rather than words x texts. The only
lists are the words inside one token and the words inside one text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions.text import repair_text
from colloquy.session import materialize

# --- fixed values: Spark's default French stop-word list (StopWordsRemover) -
FRENCH_STOP_WORDS = [
    "au", "aux", "avec", "ce", "ces", "dans", "de", "des", "du", "elle", "en", "et", "eux", "il", "je", "la", "le",
    "les", "leur", "lui", "ma", "mais", "me", "même", "mes", "moi", "mon", "ne", "nos", "notre", "nous", "on", "ou",
    "par", "pas", "pour", "qu", "que", "qui", "sa", "se", "ses", "son", "sur", "ta", "te", "tes", "toi", "ton",
    "tu", "un", "une", "vos", "votre", "vous", "c", "d", "j", "l", "à", "m", "n", "s", "t", "y", "été", "étée",
    "étées", "étés", "étant", "étante", "étants", "étantes", "suis", "es", "est", "sommes", "êtes", "sont", "serai",
    "seras", "sera", "serons", "serez", "seront", "serais", "serait", "serions", "seriez", "seraient", "étais",
    "était", "étions", "étiez", "étaient", "fus", "fut", "fûmes", "fûtes", "furent", "sois", "soit", "soyons",
    "soyez", "soient", "fusse", "fusses", "fût", "fussions", "fussiez", "fussent", "ayant", "ayante", "ayantes",
    "ayants", "eu", "eue", "eues", "eus", "ai", "as", "avons", "avez", "ont", "aurai", "auras", "aura", "aurons",
    "aurez", "auront", "aurais", "aurait", "aurions", "auriez", "auraient", "avais", "avait", "avions", "aviez",
    "avaient", "eut", "eûmes", "eûtes", "eurent", "aie", "aies", "ait", "ayons", "ayez", "aient", "eusse", "eusses",
    "eût", "eussions", "eussiez", "eussent",
]
WORD_PATTERN = r"\p{L}+"
MAX_GRAM = 6
# ---------------------------------------------------------------------------


def pair_corpus(pairs: DataFrame, responses: DataFrame, questions: DataFrame, id_col: str = "id",
                text_id: str = "doc_id") -> DataFrame:
    """For each side of a pair, its responses followed by its questions;
    ``n_texts`` = number of texts on that side (grouped count joined back).

    ``pairs`` has (pair_id, side, id)."""
    texts = responses.withColumn("kind", F.lit("response")).unionByName(
        questions.withColumn("kind", F.lit("question")))
    corpus = pairs.join(texts, id_col)
    n = corpus.groupBy("pair_id", "side").agg(F.count("*").alias("n_texts"))
    return corpus.join(n, ["pair_id", "side"])


def content_words(df: DataFrame, keys: Sequence[str], text: str = "text",
                  stop_words: Sequence[str] = FRENCH_STOP_WORDS, lexicon: DataFrame | None = None,
                  keep_pos: Sequence[str] | None = None) -> DataFrame:
    """Rows (keys, pos, word): lower-cased letter runs (no punctuation, no
    numbers) without stop words, with their position in the text. The stop
    list is an ``isin`` (a hash set inside generated code). With a
    ``lexicon`` (form, lemma, pos) words become lemmas and only parts of
    speech in ``keep_pos`` stay (a join with the lexicon table)."""
    keys = list(keys)
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD_PATTERN), 0)
    out = df.select(*keys, F.posexplode(words).alias("pos", "word")).filter(~F.col("word").isin(list(stop_words)))
    if lexicon is not None:
        lx = lexicon.select(F.col("form").alias("word"), "lemma", F.col("pos").alias("tag"))
        out = out.join(lx, "word", "left")
        if keep_pos is not None:
            out = out.filter(F.col("tag").isNull() | F.col("tag").isin(list(keep_pos)))
        out = out.select(*keys, "pos", F.coalesce("lemma", "word").alias("word"))
    return out


def distinct_words(tokens: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D3: set of words per key (rows)."""
    return tokens.select(*keys, "word").distinct()


def _gram_rows(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Substrings of ``col`` as rows (keys, col, q, g): every length 1..``MAX_GRAM``
    at every position. Built with explode and ``substr`` (no lambdas, so it stays
    in generated code)."""
    n = F.char_length(F.col(col))
    pos = df.select(*keys, col, F.explode(F.sequence(F.lit(1), n)).alias("_i"))
    grams = F.array(*[F.when(F.col("_i") + (q - 1) <= F.char_length(F.col(col)),
                             F.struct(F.lit(q).alias("q"), F.substr(F.col(col), F.col("_i"), F.lit(q)).alias("g")))
                      for q in range(1, MAX_GRAM + 1)])
    return pos.select(*keys, col, F.explode(grams).alias("qg")).filter(F.col("qg").isNotNull()) \
        .select(*keys, col, "qg.q", "qg.g")


def containment(words: DataFrame, text_tokens: DataFrame, pair: str = "pair_id") -> DataFrame:
    """For each (pair, word) and each side of the pair, the number of
    texts whose cleaned text contains the word as a substring.

    ``words``: (pair, word); ``text_tokens``: (pair, side, text_id, token).

    Index: every substring of length 1..6 at every position of each distinct
    token (the first letters of each suffix), solved once for all pairs. A word of
    at most 6 letters is looked up by itself, so every match is a hit; a longer word
    by its first 6 letters, and the candidates are verified with ``contains``.

    Every token then carries the words inside it to the texts it occurs in; a text
    merges its tokens' lists, so each of its words counts once, and texts are
    counted per word map-side."""
    texts = text_tokens.select(pair, "side", "text_id", "token").distinct()
    index = _gram_rows(text_tokens.select("token").distinct(), [], "token")
    wq = F.least(F.char_length("word"), F.lit(MAX_GRAM))
    w = words.select("word").distinct().select("word", wq.alias("q"), F.substr(F.col("word"), F.lit(1), wq).alias("g"))
    verified = (F.char_length("word") <= MAX_GRAM) | F.col("token").contains(F.col("word"))
    inside = w.join(index, ["q", "g"]).filter(verified).groupBy("token").agg(F.collect_set("word").alias("_inside"))
    per_text = texts.join(inside, "token").groupBy(pair, "side", "text_id").agg(
        F.array_distinct(F.flatten(F.collect_list("_inside"))).alias("_words"))
    counted = per_text.select(pair, "side", F.explode("_words").alias("word")).groupBy(pair, "word", "side").agg(
        F.count("*").alias("n_containing"))
    return counted.join(words.select(pair, "word").distinct(), [pair, "word"], "left_semi")


def contrast_score(df_own: F.Column, n_own: F.Column, df_other: F.Column, n_other: F.Column) -> F.Column:
    """``(df_own/N_own) * ln(N_other/(df_other+1))``; may be negative."""
    return (df_own.cast("double") / n_own) * F.log(n_other.cast("double") / (df_other + F.lit(1)))


def top_keyword(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Best word per key by score desc, word asc (a grouped ``min_by``),
    then B1 ``no_nbsp`` on the word."""
    best = scores.groupBy(*keys).agg(
        F.min_by(F.struct("word", "score"), F.struct((-F.col("score")).alias("s"), F.col("word"))).alias("b"))
    return best.select(*keys, repair_text(F.col("b.word"), "no_nbsp").alias("keyword"), F.col("b.score").alias("score"))


def keyword_table(corpus: DataFrame, text: str = "text", text_id: str = "doc_id") -> DataFrame:
    """D2-D5 together: per (pair, side, word) the containment counts on both
    sides and the contrast score. ``corpus`` is the output of ``pair_corpus``."""
    words = content_words(corpus.select("pair_id", "side", F.col(text_id).alias("text_id"), text),
                          ["pair_id", "side", "text_id"], text)
    tokens = words.select("pair_id", "side", "text_id", F.col("word").alias("token"))
    # the token table feeds four branches (side words, vocabulary, text hits,
    # counts): write it once to the shared folder and read it back, instead
    # of re-tokenising the corpus in every branch (cuts the lineage too)
    tokens = materialize(tokens, "keyword-tokens")
    side_words = distinct_words(tokens.withColumnRenamed("token", "word"), ["pair_id", "side"])
    cont = containment(side_words.select("pair_id", "word"), tokens)
    # one row per (pair, word) with the containing-text count of each side
    sides = cont.groupBy("pair_id", "word").agg(
        F.sum(F.when(F.col("side") == 0, F.col("n_containing"))).alias("_c0"),
        F.sum(F.when(F.col("side") == 1, F.col("n_containing"))).alias("_c1"))
    n = corpus.groupBy("pair_id").agg(
        F.max(F.when(F.col("side") == 0, F.col("n_texts"))).alias("_n0"),
        F.max(F.when(F.col("side") == 1, F.col("n_texts"))).alias("_n1"))
    t = side_words.join(sides, ["pair_id", "word"], "left").join(n, "pair_id")
    zero = F.lit(0).cast("bigint")
    own0 = F.col("side") == 0
    t = t.select(
        "pair_id", "side", "word",
        F.when(own0, F.col("_n0")).otherwise(F.col("_n1")).alias("n_texts"),
        F.when(own0, F.col("_n1")).otherwise(F.col("_n0")).alias("n_other"),
        F.coalesce(F.when(own0, F.col("_c0")).otherwise(F.col("_c1")), zero).alias("df_own"),
        F.coalesce(F.when(own0, F.col("_c1")).otherwise(F.col("_c0")), zero).alias("df_other"))
    # a pair with texts on one side only has no contrast (ln of 0 texts)
    t = t.filter(F.col("n_other").isNotNull())
    return t.withColumn("score", contrast_score(F.col("df_own"), F.col("n_texts"), F.col("df_other"), F.col("n_other")))
