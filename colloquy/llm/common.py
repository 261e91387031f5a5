"""Helpers shared by the corpus operators: columns, word hashes, connected components."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.session import materialize

MULT = np.uint64(0x9E3779B97F4A7C15)


def id_text(docs: DataFrame) -> DataFrame:
    """The two columns most operators read; every other column of the input,
    whatever its name, is left out before the first step."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def held_out(doc_id: Column) -> Column:
    """True where no label may be learned: crc32 of the id as text, mod 4, is 2.
    A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def in_share(hashed: Column, wanted: int, rows: int) -> Column:
    """True for about ``wanted`` of ``rows`` rows by a 64-bit hash, compared with the
    share on its full range: no share is rounded to nothing at any number of rows."""
    if rows <= wanted:
        return F.lit(True)
    return hashed < F.lit(-2**63 + max(1, 2**64 * wanted // rows))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64), element-wise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(words) -> np.ndarray:
    """64-bit hash of each word (bytes or str)."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (empty if there is none)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    acc = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        acc *= MULT
        acc += h[i:i + n]
    return mix(acc)


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as the signed longs Spark stores."""
    return x.astype(np.uint64, copy=False).view(np.int64)


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the smallest
    node reachable. Alternating large-star and small-star rounds: each is a
    grouped minimum (combined map-side) joined back, so no neighbourhood is
    gathered; every round is written to the shared folder, which cuts the lineage."""
    norm = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = materialize(norm.distinct(), name)
    while not _stars(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = materialize(large, name)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b")
            .where("a <> b").distinct())
        e = materialize(small, name)
    pairs = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), F.col("root")).distinct())


def _stars(e: DataFrame) -> bool:
    """True if every node has one edge and no root has one: the edges name the roots."""
    nodes = e.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    roots = e.select(F.col("b").alias("a")).distinct().withColumn("root", F.lit(True))
    return nodes.join(roots, "a", "left").where("n > 1 or root").isEmpty()
