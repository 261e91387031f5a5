"""Corpus assembly (H1-H5): merging intent and example lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions.text import repair_text


def merge_lists(a: DataFrame, b: DataFrame) -> DataFrame:
    """H1: concatenate two lists, duplicates kept."""
    return a.unionByName(b)


def merge_by_priority(sources: Sequence[DataFrame], key: str) -> DataFrame:
    """H2: key union where a later source replaces the *whole* variant list of
    a key. Winner per key by a grouped max (map-side), then a join on
    (key, priority) keeps that source's rows."""
    tagged = None
    for prio, df in enumerate(sources, start=1):
        t = df.withColumn("_prio", F.lit(prio))
        tagged = t if tagged is None else tagged.unionByName(t)
    best = tagged.groupBy(key).agg(F.max("_prio").alias("_prio"))
    return tagged.join(best, [key, "_prio"]).withColumnRenamed("_prio", "priority")


def augment_examples(a: DataFrame, b: DataFrame, key: str, text: str = "text") -> DataFrame:
    """H3: second set of examples appended to the same intent (part 2 after
    part 1), intents found only in the second set after all others
    (``intent_order`` 2); texts repaired with B1 ``full``."""
    first_keys = a.select(key).distinct().withColumn("_in_a", F.lit(True))
    both = a.withColumn("part", F.lit(1)).unionByName(b.withColumn("part", F.lit(2)))
    return (
        both.join(first_keys, key, "left")
        .withColumn("intent_order", F.when(F.col("_in_a"), F.lit(1)).otherwise(F.lit(2)))
        .withColumn(text, repair_text(F.col(text), "full"))
        .drop("_in_a")
    )


def vocabulary(df: DataFrame, col: str) -> DataFrame:
    """H4: sorted distinct names."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def group_count(df: DataFrame, key: str) -> DataFrame:
    """H5: texts per id (partial aggregation)."""
    return df.groupBy(key).agg(F.count("*").alias("n_texts"))


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    """H5: number of distinct ids."""
    return df.agg(F.countDistinct(key).alias("n_ids"))
