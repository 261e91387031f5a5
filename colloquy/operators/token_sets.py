"""I1 on items of several words: token-set similarity.

Both texts become sets of folded words. With the shared words in order as one text, and each
side's own words behind them as two more, the similarity is the best of the three pairs:
``100 * 2 * LCS / (total length)``, where LCS is the longest common subsequence of two texts
(what insertions and deletions leave). So order and repeats do not matter, a subset is equal to
its superset, and misspelled words still count.

Candidates come from two exact prefix filters over sets, so that only pairs that share something
rare are compared:

* shared words alone reach the cutoff only if they hold more than two thirds of one side's length
  (at 80): one of that side's rarest words, as far as the rest could not do it alone, is shared;
* the other pair reaches it only if the two texts share more than ``0.2 * total length + 1`` of
  their letter pairs (a text of n letters, padded with a blank on both sides, has n + 1 pairs,
  whatever the order of its words; a deletion loses two of them, an insertion one), which is more
  than ``n / 3 + 1`` for either side: one of the rarest pairs of each side is shared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions.text import fold_text
from colloquy.session import materialize

TOKEN = r"[\p{L}\p{N}]+"
BITS = 62  # letters of a text per whole number


def lcs_length(x: Column, y: Column) -> Column:
    """Length of the longest common subsequence of two arrays of letters, bit-parallel: one bit per
    letter of ``x``; a letter of ``y`` adds the matching bits to the vector, and the zeros that are
    left at the end count. Carries go from word to word, so texts may have any length."""
    long, full = (lambda v: F.lit(v).cast("long")), F.lit(2**BITS - 1).cast("long")
    words = F.sequence(F.lit(0), F.greatest(F.floor((F.size(x) - 1) / BITS).cast("int"), F.lit(0)))

    def bits(w, keep):  # one whole number: the bits b whose letter is kept
        return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), long(0), lambda acc, b: F.when(
            keep(F.get(x, w * BITS + b)), acc.bitwiseOR(F.call_function("shiftleft", long(1), b))).otherwise(acc))

    held = F.transform(words, lambda w: bits(w, lambda letter: letter.isNotNull()))
    masks = F.map_from_entries(F.transform(F.array_distinct(x), lambda c: F.struct(
        c, F.transform(words, lambda w: bits(w, lambda letter: F.coalesce(letter == c, F.lit(False)))))))

    def step(state, letter, m, h):
        mask = F.try_element_at(m, letter)

        def word(acc, w):
            v, hit = F.get(state, w), F.get(state, w).bitwiseAND(F.get(mask, w))
            total = v + hit + acc["carry"]
            new = total.bitwiseAND(full).bitwiseOR(v - hit).bitwiseAND(F.get(h, w))
            return F.struct(F.concat(acc["out"], F.array(new)).alias("out"), F.shiftright(total, BITS).alias("carry"))

        moved = F.aggregate(words, F.struct(F.array().cast("array<bigint>").alias("out"), long(0).alias("carry")), word,
                            lambda acc: acc["out"])
        return F.when(mask.isNull(), state).otherwise(moved)

    # the masks are worked out once per pair and carried along
    start = F.struct(held.alias("v"), masks.alias("m"), held.alias("h"))
    end = F.aggregate(y, start, lambda acc, c: F.struct(
        step(acc["v"], c, acc["m"], acc["h"]).alias("v"), acc["m"].alias("m"), acc["h"].alias("h")), lambda acc: acc["v"])
    ones = F.aggregate(end, F.lit(0), lambda s, v: s + F.bit_count(v))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0)).otherwise(F.size(x) - ones)


def word_set(text: Column) -> Column:
    """The distinct folded words of a text, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(fold_text(text), F.lit(TOKEN), 0)))


def _letters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def token_set_similarity(a: Column, b: Column) -> Column:
    """Similarity in 0..100 of two word sets (sorted arrays); 0 if either is empty."""
    both = F.array_sort(F.array_intersect(a, b))
    shared = F.array_join(both, " ")
    one, other = (F.array_join(F.concat(both, F.array_sort(F.array_except(p, q))), " ") for p, q in ((a, b), (b, a)))
    n0, n1, n2 = F.char_length(shared), F.char_length(one), F.char_length(other)

    def part(n):  # the shared words begin both texts
        return F.when(n0 > 0, F.lit(200.0) * n0 / (n0 + n)).otherwise(F.lit(0.0))

    whole = F.lit(200.0) * lcs_length(_letters(one), _letters(other)) / (n1 + n2)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.greatest(part(n1), part(n2), whole))


def _rare_first(each: DataFrame, feature: str) -> DataFrame:
    counts = each.groupBy(feature).agg(F.count(F.lit(1)).alias("_f"))
    return each.join(counts, feature)


def _pairs(texts: DataFrame) -> DataFrame:
    """(side, id, n, feature): the rarest letter pairs of every text, as many as the filter needs."""
    grams = F.array_sort(F.transform(F.sequence(F.lit(1), F.col("n") + 1), lambda i: F.substr(
        F.concat(F.lit(" "), F.col("joined"), F.lit(" ")), i, F.lit(2))))
    numbered = F.transform("g", lambda g, i: F.concat(g, (i - F.array_position("g", g) + 1).cast("string")))  # repeats apart
    each = _rare_first(texts.withColumn("g", grams).select("side", "id", "n", F.explode(numbered).alias("feature")), "feature")
    at = F.row_number().over(Window.partitionBy("side", "id").orderBy("_f", "feature"))
    need = F.floor(F.col("n") / 3 + 1) + 1
    return each.withColumn("_at", at).where(F.col("_at") <= F.col("n") + 1 - need + 1).select("side", "id", "n", "feature")


def _tokens(texts: DataFrame) -> DataFrame:
    """(side, id, feature, lead): every word; ``lead`` if the words after it in order of rarity
    could not make up two thirds of the text without it."""
    each = _rare_first(texts.select("side", "id", "n", F.explode("tokens").alias("feature")), "feature")
    rest = F.sum(F.char_length("feature") + 1).over(Window.partitionBy("side", "id").orderBy(F.desc("_f"), F.desc("feature"))) - 1
    return each.select("side", "id", "feature", (3 * rest > 2 * F.col("n")).alias("lead"))


def token_set_match(words: DataFrame, vocab: DataFrame, keys: Sequence[str], word: str = "word", item: str = "item") -> DataFrame:
    """Rows (keys, word, item, similarity) of all items whose token-set similarity to the word
    is above 80, rounded to six places. Texts without a word match nothing; null is no text."""
    keys = list(keys)
    left = words.select(F.col(word).alias("id")).where("id is not null").distinct().withColumn("side", F.lit(0))
    right = vocab.select(F.col(item).alias("id")).where("id is not null").distinct().withColumn("side", F.lit(1))
    texts = left.unionByName(right).withColumn("tokens", word_set(F.col("id"))).where(F.size("tokens") > 0)
    texts = materialize(texts.withColumn("joined", F.array_join("tokens", " ")).withColumn("n", F.char_length("joined")), "token-sets")
    pairs, tokens = materialize(_pairs(texts), "token-pairs"), materialize(_tokens(texts), "token-words")

    def sides(df, *more):
        return [df.where(F.col("side") == s).select(F.col("id").alias(name), "feature", *[F.col(c).alias(f"{c}{s}") for c in more])
                for s, name in ((0, "a"), (1, "b"))]

    p0, p1 = sides(pairs, "n")
    near = p0.join(p1, "feature").where("2 * n0 < 3 * n1 and 2 * n1 < 3 * n0").select("a", "b")
    t0, t1 = sides(tokens, "lead")
    some = t0.join(t1, "feature").where("lead0 or lead1").select("a", "b")
    found = near.unionByName(some).distinct()
    sets = texts.select("id", "tokens", "side")
    found = found.join(sets.where("side = 0").select(F.col("id").alias("a"), F.col("tokens").alias("ta")), "a").join(
        sets.where("side = 1").select(F.col("id").alias("b"), F.col("tokens").alias("tb")), "b")
    scored = found.withColumn("similarity", F.round(token_set_similarity(F.col("ta"), F.col("tb")), 6)).where("similarity > 80")
    return words.join(scored.select(F.col("a").alias(word), F.col("b").alias(item), "similarity"), word).select(
        *keys, word, item, "similarity").distinct()
