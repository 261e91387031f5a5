"""Operator 11: importance resampling towards a target distribution.

Method: all texts and all target texts are counted into ``BUCKETS`` hashed word buckets;
the log ratio of the two smoothed shares is a bucket's gain. A document's weight is an array
lookup per word and a mean, and its score adds Gumbel noise hashed from its id, so that the
highest scores are a draw without replacement by weight.

Ranks come from a distributed LSD radix sort. The composite key is (long before short score,
small doc_id first, null ids last). Keys are cut into digits of ``DIGIT_BITS`` bits; digits
that are equal in all rows are left out. A pass is a stable counting sort by one digit, least
significant first: rows stand in blocks of ``BLOCK_ROWS`` places, every block counts its
digits, prefix sums over (digit, block) give each block's first destination for each digit,
and a row's destination is that plus its rank among its block's rows of that digit. After
the last pass the destination is the final rank. Destinations are gapless, so blocks are even
whatever the keys, and a group that is ranked holds at most ``BLOCK_ROWS`` rows. Each pass is
written to the shared folder, which also lets a lost executor's work be repeated from there.
Before the first pass the counts of the leading digit tell which of its values lie wholly
below the last rank to draw; those rows are never moved.

The driver sees the bucket counts (``BUCKETS`` rows), a few totals and nothing else.

Defined results: a text that is null or has no word has weight 0 and is never drawn; a null
doc_id hashes as no digits and comes last among equal scores; repeated rows are rows of their
own, each with a rank; an empty target leaves the documents' own shares in the gains; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import id_text
from colloquy.session import materialize, read_table

BUCKETS, SEED, LEAST_WORDS, PERCENT = 10_000, 2024, 20, 10
DIGIT_BITS, BLOCK_ROWS = 12, 65_536
#: Letters A-Z in lower case, letters, digits and all bytes of other code points as they are, a space for the rest.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def buckets_of(text: bytes | None, buckets: int) -> np.ndarray:
    """Bucket of every word of a text."""
    words = text.translate(FOLD).split() if text else []
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """Words per bucket over all rows; a task sends at most ``buckets`` rows."""
    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total += np.bincount(buckets_of(text, buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    each = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    n, whole, goal = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (whole + n) / ((s + 1) * (goal + n))))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def noise(code: int) -> int:
    """Gumbel noise of a 32-bit hash, in thousandths."""
    return math.floor(-1000 * math.log(-math.log((code + 0.5) / 4294967296)))


def weigh(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score of every row."""
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    slim = id_text(docs).select("doc_id", F.col("text").cast("binary").alias("text"), F.substring(code, 1, 8).alias("code"))
    goal = target.select(target["text"].cast("string").alias("text"))
    gain = gains(bucket_counts(slim, buckets), bucket_counts(goal, buckets))

    def run(batches):
        for batch in batches:
            at = [buckets_of(t, buckets) for t in batch.column("text").to_pylist()]
            n = np.array([len(a) for a in at], dtype=np.int64)
            weight = np.array([int(gain[a].sum()) // max(1, len(a)) for a in at], dtype=np.int64)
            luck = np.array([noise(int(c, 16)) for c in batch.column("code").to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, weight, weight + luck))],
                names=["doc_id", "n_features", "weight", "score"])

    return slim.mapInArrow(run, "doc_id long, n_features long, weight long, score long")


def digit_columns(rows: DataFrame, keys: list[str]) -> list[Column]:
    """Digits of the composite key ``keys`` (longs whose unsigned order is wanted, most
    significant key first), least significant digit first, without those that no two rows
    tell apart."""
    either = rows.agg(*[F.bit_or(k).alias(f"{k}_or") for k in keys], *[F.bit_and(k).alias(f"{k}_and") for k in keys]).first()
    out = []
    for k in reversed(keys):
        varies = ((either[f"{k}_or"] or 0) ^ (either[f"{k}_and"] or 0)) & (2**64 - 1)
        for shift in range(0, varies.bit_length(), DIGIT_BITS):
            if varies >> shift & (2**DIGIT_BITS - 1):
                out.append(F.shiftrightunsigned(k, shift).bitwiseAND(F.lit(2**DIGIT_BITS - 1)).cast("int"))
    return out


def counting_pass(rows: DataFrame, digit: Column) -> DataFrame:
    """One stable counting sort: ``place`` (0-based, gapless) becomes the place by ``digit``."""
    rows = rows.withColumns({"_digit": digit, "_block": F.floor(F.col("place") / BLOCK_ROWS)})
    counts = rows.groupBy("_digit", "_block").count()
    totals = counts.groupBy("_digit").agg(F.sum("count").alias("_total"))  # at most 2^DIGIT_BITS rows
    below = totals.select("_digit", (F.sum("_total").over(Window.orderBy("_digit")) - F.col("_total")).alias("_below"))
    before = F.sum("count").over(Window.partitionBy("_digit").orderBy("_block")) - F.col("count")
    offsets = counts.join(F.broadcast(below), "_digit").select(
        "_digit", "_block", (F.col("_below") + before).alias("_offset"))
    local = F.row_number().over(Window.partitionBy("_digit", "_block").orderBy("place")) - 1
    ranked = rows.withColumn("_local", local).join(offsets, ["_digit", "_block"])
    return ranked.withColumn("place", F.col("_offset") + F.col("_local")).drop(
        "_digit", "_block", "_offset", "_local")


def numbered(rows: DataFrame) -> DataFrame:
    """``place``: 0-based gapless numbers in any order, from the sizes of the partitions
    of a written table (``row`` is monotonically_increasing_id)."""
    part = F.shiftright("row", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("row").alias("_first"))
    local = F.row_number().over(Window.partitionBy("_part", "_slice").orderBy("row")) - 1
    # a partition is ranked in slices of its row numbers, however large it is
    sliced = rows.withColumns({"_part": part, "_slice": F.floor(F.col("row") / BLOCK_ROWS)})
    counts = sliced.groupBy("_part", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    inside = F.sum("_n").over(Window.partitionBy("_part").orderBy("_slice")) - F.col("_n")
    outside = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    starts = counts.withColumn("_inside", inside).drop("_n").join(outside, "_part")
    return sliced.withColumn("_local", local).join(starts, ["_part", "_slice"]).select(
        *rows.columns, (F.col("_before") + F.col("_inside") + F.col("_local")).alias("place"))


def radix_order(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (with a unique long ``row``) with their place in the order of the composite key."""
    out = materialize(numbered(rows), "radix_pass")
    for digit in digit_columns(out, keys):
        out = materialize(counting_pass(out, digit), "radix_pass")
    return out


def lead(rows: DataFrame, key: str, want: int) -> DataFrame:
    """The rows whose ``key`` (non-negative, small first) can be among the first ``want``:
    whole values of its leading digit, until they hold enough."""
    bits = max(0, int(rows.agg(F.max(key)).first()[0] or 0).bit_length() - DIGIT_BITS)
    top = F.shiftright(key, bits)
    held = 0
    for r in sorted(rows.groupBy(top.alias("d")).count().collect()):  # at most 2^DIGIT_BITS rows
        held += r["count"]
        if held >= want:
            return rows.where(top <= r["d"])
    return rows


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank (from 1; null if not drawn) of every row."""
    scored = materialize(weigh(docs, target, buckets, seed).withColumn("row", F.monotonically_increasing_id()), "resample")
    fit = scored.where(F.col("n_features") >= least_words)
    n, best = fit.agg(F.count(F.lit(1)), F.max("score")).first()
    want = percent * n // 100
    unsigned = F.col("doc_id").bitwiseXOR(F.lit(-2**63))  # the sign bit turned: unsigned order is signed order
    keyed = fit.select("row", (F.lit(best) - F.col("score")).cast("long").alias("k_score"),
                       F.col("doc_id").isNull().cast("long").alias("k_null"),
                       F.coalesce(unsigned, F.lit(0).cast("long")).alias("k_id"))
    first = lead(keyed, "k_score", want) if want else keyed.limit(0)
    drawn = radix_order(first, ["k_score", "k_null", "k_id"]).where(F.col("place") < want)
    ranks = drawn.select("row", (F.col("place") + 1).alias("rank"))
    return scored.join(ranks, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")


def op11(spark, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


# DuckDB has no crc32: it is taken bit by bit over the distinct words' bytes.
OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
dw AS (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(words) AS word FROM d) GROUP BY r, word),
bw AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM b) GROUP BY word),
each AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
crc AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(0, length(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)),
      lambda a, x: list_reduce(list_prepend(xor(a, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
          lambda c, z: xor(c >> 1, (c & 1) * 3988292384))), 4294967295) % 10000 AS bucket
  FROM each),
s AS (SELECT bucket, sum(n) AS s FROM dw JOIN crc USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM bw JOIN crc USING (word) GROUP BY bucket),
tot AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::DOUBLE AS ss, coalesce((SELECT sum(t) FROM t), 0)::DOUBLE AS tt),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (ss + 10000) / ((s + 1)::DOUBLE * (tt + 10000))))::BIGINT AS g
  FROM s LEFT JOIN t USING (bucket), tot),
w AS (SELECT r, floor(sum(n * g)::DOUBLE / sum(n))::BIGINT AS weight FROM dw JOIN crc USING (word) JOIN gain USING (bucket) GROUP BY r),
sc AS (
  SELECT d.r, doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT
             + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN w ON w.r = d.r),
k AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM sc WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM sc LEFT JOIN k ON k.r = sc.r
"""
