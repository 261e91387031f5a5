"""Operator 1: benchmark decontamination by greedy string tiling.

Method: texts become lower-cased letter-and-digit tokens. Document and benchmark
item are joined on shared seeds (hashes of ``SEED`` = five tokens); for a joined
pair, Karp-Rabin hashes of the unmarked windows find the longest common run, which is
marked as a tile, again and again, until no common run of five tokens is left
(:func:`tiles`). An item leaks into a document if the tiles cover ``COVERAGE`` = 0.8 of
its tokens, in whatever order the passages come.

A document's seeds are not shuffled as such: a bitmap of ``BITS`` bits (2 MB
whatever the benchmark's size) first drops windows that no item has; a false
positive of the bitmap only costs a join row. Of an item only the rarest seeds are
joined, so many that no leak is lost (:func:`rare_seeds`): a phrase that many items
share makes no pairs. A pair whose shared positions cannot add up to the coverage is
not tiled.

Defined results: null and empty texts, and items shorter than five tokens, never
match; items with equal tokens count as one, named by the smallest item_id; different
items of one item_id, or without one, are judged each; ties between equally long runs
go to the earlier item position, then the earlier document position; a doc_id on several
rows is judged row by row; null doc_ids are kept as null; texts of one token repeated
many times cost no more than others of their length; empty tables give an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import MULT, gram_hashes, id_text, signed, word_hashes
from colloquy.session import materialize, read_table

SEED, COVERAGE, BITS, GROUP = 5, 0.8, 24, 1 << 16
_INVERSE = np.uint64(pow(int(MULT), -1, 2**64))
TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> np.ndarray:
    return word_hashes(TOKEN.findall(text.lower())) if text else np.empty(0, dtype=np.uint64)


class _Windows:
    """Karp-Rabin hashes of windows of any length over one token sequence."""

    def __init__(self, x: np.ndarray):
        power = np.cumprod(np.r_[np.uint64(1), np.full(len(x), MULT)], dtype=np.uint64)
        self.sums = np.r_[np.uint64(0), np.cumsum(x * power[:-1], dtype=np.uint64)]
        self.back = np.cumprod(np.r_[np.uint64(1), np.full(len(x), _INVERSE)], dtype=np.uint64)

    def at(self, places: np.ndarray, length: int) -> np.ndarray:
        return (self.sums[places + length] - self.sums[places]) * self.back[places]


def _ahead(live: np.ndarray) -> np.ndarray:
    """How many live positions follow one another from each position on."""
    at = np.arange(len(live))
    return np.minimum.accumulate(np.where(live, len(live), at)[::-1])[::-1] - at


def _known(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in ``found`` (sorted, not empty)."""
    return found[np.minimum(np.searchsorted(found, x), len(found) - 1)] == x


def tiles(item: np.ndarray, doc: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item position, document position, length), longest first.

    Each round finds the greatest length at which unmarked windows of both sides agree
    (by halving, on hashes) and marks all such windows that do not overlap, in the order of
    their places. No list of position pairs is made: memory grows with the two lengths, and
    rounds are as many as there are different tile lengths (their sum is an item at most)."""
    a, b = gram_hashes(item, least), gram_hashes(doc, least)
    if not len(a) or not len(b):
        return []
    live_b = _known(b, np.sort(a))
    if not live_b.any():
        return []
    live_a = _known(a, np.unique(b[live_b]))
    hash_a, hash_b = _Windows(item), _Windows(doc)
    used, out, top = np.zeros(len(doc), bool), [], len(item)
    while True:
        ahead_a, ahead_b = _ahead(live_a), _ahead(live_b)
        top = min(top, int(min(ahead_a.max(), ahead_b.max())) + least - 1)
        if top < least:
            return out

        def windows(length):
            x, y = np.flatnonzero(ahead_a > length - least), np.flatnonzero(ahead_b > length - least)
            return x, hash_a.at(x, length), y, hash_b.at(y, length)

        def agree(length):
            _, hx, _, hy = windows(length)
            return len(hx) > 0 and len(hy) > 0 and bool(_known(hx, np.sort(hy)).any())

        low, high = least - 1, top + 1  # agree up to low, not from high on
        length = top
        while high - low > 1:
            low, high = (length, high) if agree(length) else (low, length)
            length = (low + high) // 2
        if low < least:
            return out
        x, hx, y, hy = windows(low)
        by = np.argsort(hy, kind="stable")
        y, hy = y[by], hy[by]
        start, stop = np.searchsorted(hy, hx, "left"), np.searchsorted(hy, hx, "right")
        free: dict[int, int] = {}  # per hash the first window that may still be unmarked
        end = 0
        for at, lo, hi in zip(x.tolist(), start.tolist(), stop.tolist()):
            if at < end or lo == hi:
                continue
            n = free.get(lo, lo)
            while n < hi and (used[y[n]] or used[y[n] + low - 1]):  # windows of one length
                n += 1
            free[lo] = n
            for to in y[n:hi]:
                if not used[to] and not used[to + low - 1] and np.array_equal(item[at:at + low], doc[to:to + low]):
                    used[to:to + low] = True
                    live_a[max(0, at - least + 1):at + low] = False
                    live_b[max(0, to - least + 1):to + low] = False
                    out.append((at, int(to), low))
                    end = at + low
                    break
        top = low - 1


def benchmark_items(bench: DataFrame) -> DataFrame:
    """(no, item_id, tokens): one numbered row per distinct token sequence of five tokens or more."""
    slim = bench.select(bench["item_id"].cast("long").alias("item_id"), bench["text"].cast("string").alias("text"))

    def run(batches):
        for pdf in batches:
            toks = [signed(tokens(t)) for t in pdf["text"]]
            yield pd.DataFrame({"item_id": pdf["item_id"].astype("Int64"), "tokens": toks})

    items = slim.mapInPandas(run, "item_id long, tokens array<long>").where(F.size("tokens") >= SEED)
    items = items.groupBy("tokens").agg(F.min("item_id").alias("item_id"))
    return materialize(items.select(F.monotonically_increasing_id().alias("no"), "item_id", "tokens"), "bench_items")


def item_seeds(items: DataFrame) -> DataFrame:
    """(no, n, seed, at): the distinct seeds of each item of n tokens and the
    number of positions each has in it; written once."""
    def run(batches):
        for pdf in batches:
            for i, t in zip(pdf["no"], pdf["tokens"]):
                seed, at = np.unique(gram_hashes(np.asarray(t, dtype=np.int64).view(np.uint64), SEED), return_counts=True)
                yield pd.DataFrame({"no": i, "n": len(t), "seed": signed(seed), "at": at})

    slim = items.select("no", "tokens")
    return materialize(slim.mapInPandas(run, "no long, n int, seed long, at long"), "bench_seeds")


def rare_seeds(seeds: DataFrame, hits: DataFrame, coverage: float) -> DataFrame:
    """(no, n, seed): the seeds of an item that meet its documents. Tiles over ``coverage`` of
    n tokens hold at least n * coverage / SEED of its n - SEED + 1 seed positions, so a leaking
    document holds one of the others even if all but the last so many are left out: the
    seeds that most documents hold are."""
    df = hits.select(F.explode("seeds").alias("seed")).groupBy("seed").agg(F.count(F.lit(1)).alias("df"))
    before = Window.partitionBy("no").orderBy(F.coalesce("df", F.lit(0)), "seed").rowsBetween(Window.unboundedPreceding, -1)
    needed = F.greatest(F.lit(1), F.ceil(F.col("n") * coverage / SEED - 1e-9))
    ranked = seeds.join(df, "seed", "left").withColumn("before", F.coalesce(F.sum("at").over(before), F.lit(0)))
    return ranked.where((F.col("before") <= F.col("n") - SEED + 1 - needed) & F.col("df").isNotNull()).select("no", "n", "seed")


def find_leaks(docs: DataFrame, bench: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per (document, item) that leaks: doc_id, item_id, coverage, n_tiles, longest, tiles."""
    return named_leaks(docs, bench, coverage).drop("name")


def named_leaks(docs: DataFrame, bench: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of :func:`find_leaks` with the SHA-256 of the document's text (name)."""
    spark = docs.sparkSession
    items = benchmark_items(bench)
    seeds = item_seeds(items)
    bit = F.shiftrightunsigned("seed", 64 - BITS)
    filled = seeds.groupBy((bit / 64).cast("int").alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - BITS}) % 64 as int))")).alias("v"))
    words = np.zeros(2 ** BITS // 64, dtype=np.int64)
    for r in filled.collect():  # at most 2^BITS / 64 rows
        words[r["w"]] = r["v"]
    sent = spark.sparkContext.broadcast(words.view(np.uint64))

    def run(batches):
        bitmap = sent.value
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                h = tokens(text)
                g = gram_hashes(h, SEED)
                at = g >> np.uint64(64 - BITS)
                hit = (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
                if hit.any():
                    rows.append((doc_id, hashlib.sha256(text.encode()).hexdigest(), signed(h), signed(np.unique(g[hit.astype(bool)]))))
            yield pd.DataFrame(rows, columns=["doc_id", "name", "tokens", "seeds"]).astype({"doc_id": "Int64"})

    hits = id_text(docs).mapInPandas(run, "doc_id long, name string, tokens array<long>, seeds array<long>")
    # written once, so the row number stays the same when a task is repeated
    hits = materialize(hits.withColumn("row", F.monotonically_increasing_id()), "leak_hits")
    pairs = (hits.select("row", F.explode("seeds").alias("seed")).join(rare_seeds(seeds, hits, coverage), "seed")
             .select("row", "no", "n").distinct())
    pairs = materialize(pairs, "leak_pairs")
    # items go to their document in groups of about GROUP tokens, however many it may hold
    groups = pairs.groupBy("row").agg(F.ceil(F.sum("n") / GROUP).alias("groups"))
    wanted = (pairs.join(groups, "row").withColumn("part", F.pmod(F.xxhash64("no"), F.col("groups")))
              .join(items, "no").groupBy("row", "part").agg(
                  F.collect_list(F.struct("item_id", F.col("tokens").alias("item"))).alias("items")))

    def tile(batches):
        for pdf in batches:
            out = []
            for doc_id, name, toks, found in zip(pdf["doc_id"], pdf["name"], pdf["tokens"], pdf["items"]):
                doc = np.asarray(toks, dtype=np.int64).view(np.uint64)
                seen = np.unique(gram_hashes(doc, SEED))
                for x in found:
                    item = np.asarray(x["item"], dtype=np.int64).view(np.uint64)
                    if _known(gram_hashes(item, SEED), seen).sum() * SEED < len(item) * coverage:
                        continue  # shared positions that cannot add up to the coverage
                    t = tiles(item, doc)
                    share = sum(k for *_, k in t) / len(item)
                    if share >= coverage:
                        out.append((doc_id, name, x["item_id"], share, len(t), t[0][2],
                                    ",".join(f"{p}:{q}:{k}" for p, q, k in sorted(t))))
            yield pd.DataFrame(out, columns=["doc_id", "name", "item_id", "coverage", "n_tiles", "longest", "tiles"]).astype(
                {"doc_id": "Int64", "item_id": "Int64"})

    return hits.drop("seeds").join(wanted, "row").select("doc_id", "name", "tokens", "items").mapInPandas(
        tile, "doc_id long, name string, item_id long, coverage double, n_tiles int, longest int, tiles string")


def drop_leaks(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents that leak no benchmark item. A row goes by its own text, whatever
    other rows have its doc_id: whether it leaks depends on the text alone."""
    bad = named_leaks(docs, bench).select(F.col("name").alias("_leak")).distinct()
    return docs.join(bad, F.sha2(docs["text"].cast("string").cast("binary"), 256) == bad["_leak"], "left_anti")


def op1(spark, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
