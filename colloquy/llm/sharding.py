"""Operator 8: a uniform shuffle into shards of exact sizes.

Method: hypergeometric communication matrix. Rows fall into ``partitions``
logical partitions by a hash of their content (so a recomputed task repeats
itself). How many rows each partition sends to each shard is drawn exactly:
partition by partition from the multivariate hypergeometric law given what is
left of every shard. Each partition permutes its rows locally and cuts the
permutation into the drawn counts; rows are exchanged; each shard permutes
again, which gives the slots.

The matrix is ``partitions`` x ``shards`` whatever the table size (both are
parameters). No permutation needs one task per partition or shard: a local rank
is a rank inside a slice of the permutation plus the number of rows in the
slices before it, and slices are short (about ``slice_rows``).

:func:`shard_documents` keeps the order of a table written in stretches (``part-00000`` and so
on, as the mixing stage writes its schedule): shards are drawn as above, and the slots of a
shard go through the stretches one after another, permuted inside each. So every shard, read
by slot, keeps the proportions of the mix. Rows that come from no file are one stretch.

Defined results: a null text has size 16 and crc32 0; a null doc_id is a row as
any other; repeated rows are rows of their own; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.session import read_table

SHARDS, PARTITIONS, SLICE_ROWS, SEED = 40, 256, 20_000, 42
MAX_LONG = float(2**63)


def draw_matrix(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """``A[p, s]`` rows of partition p for shard s: row sums ``counts``, column
    sums as equal as possible, drawn from the exact joint law."""
    n = int(counts.sum())
    left = np.full(shards, n // shards, dtype=np.int64)
    left[: n % shards] += 1
    rng = np.random.Generator(np.random.PCG64(seed))
    out = np.zeros((len(counts), shards), dtype=np.int64)
    for p, c in enumerate(counts):
        rest, want = int(left.sum()), int(c)
        for s in range(shards):  # conditional univariate draws, exact for any size
            rest -= int(left[s])
            take = want if rest == 0 else _hyper(rng, int(left[s]), rest, want)
            out[p, s], want = take, want - take
        left -= out[p]
    return out


def _hyper(rng, good: int, bad: int, n: int) -> int:
    if n == 0 or good == 0:
        return 0
    if bad == 0:
        return n
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n))
    return _invert(rng.random(), good, bad, n)  # beyond the generator's range


def _invert(u: float, good: int, bad: int, n: int) -> int:
    """The hypergeometric quantile of ``u``: probabilities follow from their ratios, as sums
    of logarithms, over all values within 40 standard deviations of the mean. Those
    outside weigh less than the least positive double."""
    total = good + bad
    mean = n * good / total
    sd = np.sqrt(mean * (bad / total) * ((total - n) / max(1, total - 1)))
    lo = max(0, n - bad, int(mean - 40 * sd) - 40)
    hi = min(n, good, int(mean + 40 * sd) + 40)
    k = np.arange(lo, hi, dtype=np.float64)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    upto = np.cumsum(np.exp(logs - logs.max()))
    return lo + int(np.searchsorted(upto, u * upto[-1], side="right"))


def _rank(df: DataFrame, group: str, order: str, ties: list[str], rows: int, name: str, after: Sequence[str] = ()) -> DataFrame:
    """0-based rank of each row inside ``group`` by ``order`` (a hash), as column
    ``name``; with ``after`` by those columns first. The hash range is cut in slices of about ``SLICE_ROWS`` rows, ranked
    one by one; the sizes of the slices before are added from a table of
    (group, slice) counts."""
    slices = max(1, -(-rows // SLICE_ROWS))
    cut = F.floor((F.col(order).cast("double") / MAX_LONG + 1) / 2 * slices).cast("long")
    df = df.withColumn("_slice", F.least(F.greatest(cut, F.lit(0)), F.lit(slices - 1)))
    cell = [*after, "_slice"]
    sizes = df.groupBy(group, *cell).count()
    before = F.coalesce(F.sum("count").over(
        Window.partitionBy(group).orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(group, *cell, before.alias("_before"))
    at = F.row_number().over(Window.partitionBy(group, *cell).orderBy(order, *ties)) - 1
    return df.withColumn("_at", at).join(sizes, [group, *cell]).withColumn(
        name, (F.col("_at") + F.col("_before")).cast("long")).drop("_slice", "_at", "_before")


def _hash(seed: int, *cols: Column) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def shard(docs: DataFrame, shards: int = SHARDS, partitions: int = PARTITIONS, seed: int = SEED,
          carry: bool = False, stretches: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot; with
    ``carry`` every column of ``docs`` (one struct ``_doc``) as well; with ``stretches`` slots
    follow the files that ``docs`` were written in."""
    text = docs["text"].cast("string")
    slim = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).alias("text_crc32"),
        *([F.struct(*[docs[c] for c in docs.columns]).alias("_doc")] if carry else []),
        *([F.coalesce(F.regexp_extract(F.input_file_name(), r"part-(\d+)[^/]*$", 1).try_cast("long"), F.lit(0)).alias("_stretch")]
          if stretches else []))
    key = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    ties = ["doc_id", "text_crc32", "size"]
    slim = slim.select("*", F.pmod(_hash(seed, *key), F.lit(partitions)).cast("int").alias("_p"),
                       _hash(seed + 1, *key).alias("_h1"), _hash(seed + 2, *key).alias("_h2"))
    counted = {r["_p"]: r["count"] for r in slim.groupBy("_p").count().collect()}  # at most ``partitions`` rows
    counts = np.array([counted.get(p, 0) for p in range(partitions)], dtype=np.int64)
    matrix = draw_matrix(counts, shards, seed)
    rows = [(p, s, int(lo), int(lo + matrix[p, s]))
            for p in range(partitions) for s, lo in enumerate(np.cumsum(matrix[p]) - matrix[p]) if matrix[p, s]]
    spark = docs.sparkSession
    cuts = spark.createDataFrame(rows, "_p int, shard int, _lo long, _hi long") if rows else \
        spark.createDataFrame([], "_p int, shard int, _lo long, _hi long")
    cuts = cuts.groupBy("_p").agg(F.array_sort(F.collect_list(F.struct("_hi", "shard"))).alias("_cuts"))
    local = _rank(slim, "_p", "_h1", ties, int(counts.max(initial=0)), "_r")
    sent = (local.join(F.broadcast(cuts), "_p")  # partitions x shards cells, fixed by the parameters
            .withColumn("shard", F.filter("_cuts", lambda c: c["_hi"] > F.col("_r"))[0]["shard"]))
    out = _rank(sent.drop("_cuts", "_r"), "shard", "_h2", ties, int(-(-counts.sum() // shards)), "slot",
                after=["_stretch"] if stretches else [])
    return out.drop("_p", "_h1", "_h2", "_stretch")


def op8(spark, sf_dir: str) -> DataFrame:
    out = shard(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The documents with their shard and slot, in the order of the stretches they were written
    in; columns of that name are replaced."""
    names = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    out = shard(docs, shards, carry=True, stretches=True)
    return out.select(*[F.col("_doc").getField(c).alias(c) for c in names], "shard", "slot")
