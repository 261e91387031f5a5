"""Recommendation (I1-I5): fuzzy item matching, one-hot vectors, nearest
neighbours on item vectors, missing items and the item phrase.

``knn_label`` is exact without comparing every query with every point: item
vectors are bit patterns of any width, points are summarised per occupied pattern
(counts per label and the first k ids), and each distinct query pattern finds the
patterns within its k-th distance through pivots (``neighbours.near_sites``, Hamming
distance). ``fuzzy_match`` compares only words that share a piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions.text import fold_text
from colloquy.operators.intents import rank_candidates
from colloquy.operators.neighbours import near_sites
from colloquy.session import materialize

# --- fixed values ----------------------------------------------------------
FUZZY_CUTOFF = 80          # similarity strictly above this keeps a match
LIST_LAST_PREFIX = "et "   # the last item of a phrase is written "et <item>"
LIST_SEPARATOR = ", "
WORD_BITS = 62             # items per whole number of a pattern
# ---------------------------------------------------------------------------


def similarity(a: Column, b: Column) -> Column:
    """Edit-distance similarity in 0..100: ``100 * (1 - lev / max_len)``; two empty
    words are equal (100)."""
    m = F.greatest(F.char_length(a), F.char_length(b))
    return F.lit(100.0) * (F.lit(1.0) - F.coalesce(F.levenshtein(a, b).cast("double") / F.nullif(m, F.lit(0)), F.lit(0.0)))


def fuzzy_match(words: DataFrame, vocab: DataFrame, keys: Sequence[str], word: str = "word",
                item: str = "item", cutoff: int = FUZZY_CUTOFF) -> DataFrame:
    """Vocabulary entries whose similarity to the folded word is above
    ``cutoff``.

    A similarity above the cutoff leaves at most ``tau`` edits for an entry's length. An
    entry is cut in tau+1 pieces; a word within tau edits holds one of them unchanged,
    at most tau places away. So distinct words and entries are joined on (entry
    length, piece number, piece) and only those pairs are compared."""
    keys = list(keys)
    w = words.select(*keys, fold_text(F.col(word)).alias("_w"), F.col(word).alias(word))
    # lengths of the pieces' strings: the largest edit count for an entry of length lv
    tau = f"greatest(0, ({100 - cutoff} * greatest(_lv, (100 * _lv - 1) div {cutoff}) - 1) div 100)"
    pieces = {"_from": "(_i * _lv) div (_tau + 1)", "_size": "((_i + 1) * _lv) div (_tau + 1) - (_i * _lv) div (_tau + 1)"}

    def cut(df):
        df = df.withColumn("_tau", F.expr(tau)).withColumn("_i", F.explode(F.expr("sequence(0L, _tau)")))
        return df.withColumns({k: F.expr(v) for k, v in pieces.items()})

    v = vocab.select(F.col(item).alias(item), fold_text(F.col(item)).alias("_v")).where("_v is not null").distinct()
    v = cut(v.withColumn("_lv", F.char_length("_v").cast("bigint"))).select(
        item, "_v", "_lv", "_i", F.expr("substring(_v, cast(_from + 1 as int), cast(_size as int))").alias("_piece"))
    d = w.select("_w").where("_w is not null").distinct().withColumn("_lw", F.char_length("_w").cast("bigint"))
    least = f"_lw - greatest(0, ({100 - cutoff} * _lw - 1) div 100)"
    d = cut(d.withColumn("_lv", F.explode(F.expr(
        f"sequence({least}, greatest({least}, (100 * _lw - 1) div {cutoff}))"))))
    places = "filter(sequence(greatest(0L, _from - _tau), greatest(0L, _from + _tau)), p -> p + _size <= _lw)"
    d = d.withColumn("_at", F.explode(F.expr(places))).select(
        "_w", "_lv", "_i", F.expr("substring(_w, cast(_at + 1 as int), cast(_size as int))").alias("_piece"))
    near = d.join(v, ["_lv", "_i", "_piece"]).select("_w", "_v", item).distinct()
    near = near.withColumn("similarity", F.round(similarity(F.col("_w"), F.col("_v")), 6)).filter(
        F.col("similarity") > F.lit(float(cutoff))).drop("_v")
    return w.join(near, "_w").select(*keys, word, item, "similarity").distinct()


def one_hot(df: DataFrame, keys: Sequence[str], item: str, items: Sequence[str]) -> DataFrame:
    """0/1 column per item of a fixed list (pivot with known values)."""
    return (df.groupBy(*keys).pivot(item, list(items)).agg(F.lit(1))
            .fillna(0, subset=list(items))
            .select(*keys, *[F.col(i).cast("int").alias(i) for i in items]))


def item_pattern(df: DataFrame, keys: Sequence[str], item: str, items: Sequence[str]) -> DataFrame:
    """Bit pattern of the items held by each key, ``WORD_BITS`` items per whole number
    (``pattern array<bigint>``). Other items are left out, and keys that hold no other."""
    at = F.array_position(F.array(*map(F.lit, items)), F.col(item)) - 1
    held = df.select(*keys, at.cast("int").alias("_at")).where("_at >= 0")
    words = [F.bit_or(F.expr(f"if(_at div {WORD_BITS} = {w}, shiftleft(1L, cast(_at % {WORD_BITS} as int)), 0L)"))
             for w in range(-(-len(items) // WORD_BITS))]
    return held.groupBy(*keys).agg(F.array(*words).alias("pattern"))


def pattern_items(pattern: Column, items: Sequence[str]) -> Column:
    """The items of a pattern, in the order of ``items``."""
    return F.filter(F.array(*map(F.lit, items)), lambda x, i: F.get(pattern, F.floor(i / WORD_BITS).cast("int")).bitwiseAND(
        F.call_function("shiftleft", F.lit(1).cast("long"), i % WORD_BITS)) != 0)


def hamming(a: Column, b: Column) -> Column:
    """Number of items that only one of two patterns holds."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0.0), lambda s, x: s + x)


def knn_label(queries: DataFrame, points: DataFrame, k: int, q_keys: Sequence[str],
              point_id: str = "point_id", label: str = "label") -> DataFrame:
    """Majority label of the k nearest points (Hamming distance on bit
    patterns; distance ties by point id; vote ties by label)."""
    q_keys = list(q_keys)
    # the training points feed three summaries: read them once
    points = materialize(points.select("pattern", point_id, label), "knn-points")
    per_pattern = points.groupBy("pattern").agg(F.count("*").alias("n"))
    label_counts = points.groupBy("pattern", label).agg(F.count("*").alias("c"))
    firsts = rank_candidates(points.select("pattern", point_id, label), ["pattern"], [F.col(point_id)], top=k,
                             out="_r")
    queries = materialize(queries.select(*q_keys, "pattern"), "knn-asked")
    asked = queries.select(F.col("pattern").alias("q")).distinct().withColumn("qv", F.col("q"))
    sites = per_pattern.select(F.col("pattern").alias("s"), F.col("pattern").alias("sv"), "n")
    pairs = materialize(near_sites(asked, sites, k, hamming, lambda theta: theta).select(
        F.col("q").alias("qpattern"), F.col("s").alias("pattern"), "n", "dist"), "knn-pairs")
    bands = pairs.groupBy("qpattern", "dist").agg(F.sum("n").alias("band_n"))
    wb = Window.partitionBy("qpattern").orderBy("dist").rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.withColumn("before", F.coalesce(F.sum("band_n").over(wb), F.lit(0)))
    full = bands.filter(F.col("before") + F.col("band_n") <= k)
    edge = bands.filter((F.col("before") < k) & (F.col("before") + F.col("band_n") > k)) \
        .withColumn("take", F.lit(k) - F.col("before"))
    full_votes = pairs.join(full.select("qpattern", "dist"), ["qpattern", "dist"]) \
        .join(label_counts, "pattern").groupBy("qpattern", label).agg(F.sum("c").alias("votes"))
    edge_pts = pairs.join(edge.select("qpattern", "dist", "take"), ["qpattern", "dist"]).join(firsts, "pattern")
    we = Window.partitionBy("qpattern").orderBy(point_id)
    edge_votes = edge_pts.withColumn("_o", F.row_number().over(we)).filter(F.col("_o") <= F.col("take")) \
        .groupBy("qpattern", label).agg(F.count("*").alias("votes"))
    votes = full_votes.unionByName(edge_votes).groupBy("qpattern", label).agg(F.sum("votes").alias("votes"))
    best = votes.groupBy("qpattern").agg(
        F.min_by(F.struct(F.col(label).alias("l"), F.col("votes").alias("v")),
                 F.struct((-F.col("votes")).alias("s"), F.col(label))).alias("_b"))
    best = best.select(F.col("qpattern").alias("pattern"), F.col("_b.l").alias("predicted_label"),
                       F.col("_b.v").cast("bigint").alias("votes"))
    return queries.join(best, "pattern").select(*q_keys, "predicted_label", "votes")


def missing_items(predicted: DataFrame, role_items: DataFrame, asked: DataFrame, keys: Sequence[str],
                  role: str = "predicted_label", item: str = "item") -> DataFrame:
    """I4: items of the predicted role that were not asked for (anti join)."""
    keys = list(keys)
    cand = predicted.select(*keys, F.col(role).alias("_role")).join(
        role_items.select(F.col(role).alias("_role"), item), "_role")
    return cand.join(asked.select(*keys, item), keys + [item], "left_anti").select(*keys, item)


def list_phrase(items: DataFrame, keys: Sequence[str], item: str, order: Column) -> DataFrame:
    """``a, b, et c`` from a key's items (the reference writes a single
    item as ``et a``). An item is named once per key, at its first place, so the list is
    bounded by the item vocabulary."""
    keys = list(keys)
    items = items.select(*keys, item, order.alias("_o"))
    arr = F.transform(F.array_sort(F.collect_list(F.struct(F.col("_o").alias("o"), F.col(item).alias("i")))),
                      lambda x: x["i"])
    items = items.groupBy(*keys, item).agg(F.min("_o").alias("_o"))
    g = items.groupBy(*keys).agg(arr.alias("_a"))
    head = F.slice("_a", 1, F.size("_a") - 1)
    last = F.concat(F.lit(LIST_LAST_PREFIX), F.element_at("_a", -1))
    return g.select(*keys, F.array_join(F.concat(head, F.array(last)), LIST_SEPARATOR).alias("phrase"))
