"""Operator 7: mixing sources to target weights (DataFrame functions only).

Method: Pfair scheduling. Source i has an integer weight ``a_i`` (its parts of
B = sum of all parts, about 1,000, or as many as the smallest share needs). Its documents, in a seeded random order, are cut into
blocks of ``block_rows``. Block j (from 0) of source i is released at slot
floor(j*B/a_i) and due by slot ceil((j+1)*B/a_i); one block runs per slot, of
those released the one due first. Total weight is one, so every block meets its
window, and after any t slots a source has run within one block of t*a_i/B.
The schedule repeats every B slots, so one period (B rows, set by the weights'
resolution, not by the data) is worked out and every later block takes its slot
from the period by ``j mod a_i``.

A document appears once. When a source has no blocks left its slots stay empty,
so the order (slot, place) goes on with the other sources in their proportions;
``in_mix`` is true in the slots before the first source runs out, where the
deviation bound holds for all of them.

Defined results: a null source is a source of its own; null texts and ids are
rows as any other; rows with the same doc_id are ordered by text, and equal rows
are interchangeable; an empty table gives an empty result; other columns pass
through untouched in ``mix_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.session import materialize, read_table

BLOCK_ROWS, RESOLUTION, ALPHA, SEED, SLICE_ROWS = 16, 1000, 0.7, "mix-42:", 2_000
STRETCHES = 64  # files of a mix, at least


def smoothed_parts(counts: DataFrame, alpha: float = ALPHA, resolution: int = RESOLUTION) -> DataFrame:
    """Target weights from source sizes: share of n^alpha in parts of about ``resolution``, or of
    as many as give the smallest share a part of its own, so that no source is lifted above its weight."""
    damped = F.pow(F.col("n").cast("double"), F.lit(alpha))
    every = Window.partitionBy(F.lit(1))  # one row per source
    whole = F.sum(damped).over(every)
    finest = F.greatest(F.lit(float(resolution)), F.ceil(whole / F.min(damped).over(every) - 1e-6))
    return counts.withColumn("parts", F.greatest(F.lit(1), F.round(damped / whole * finest)).cast("long"))


def one_period(parts: DataFrame) -> DataFrame:
    """Earliest deadline first over one period. ``parts(key, parts)`` to
    ``(key, parts, period, j, at)``: block j of each period runs at its slot ``at``."""
    lists = parts.groupBy().agg(F.array_sort(F.collect_list(F.struct("key", "parts"))).alias("s"))
    lists = lists.where(F.size("s") > 0).withColumn(
        "b", F.aggregate("s", F.lit(0).cast("long"), lambda acc, x: acc + x["parts"]))
    # the state: blocks run so far by source; and the sources picked, slot by slot
    lists = lists.withColumn("picked", F.expr("""
        aggregate(sequence(0L, b - 1L),
          named_struct('run', transform(s, x -> 0L), 'out', cast(array() as array<int>)),
          (st, t) -> transform(array(array_min(transform(
                 filter(sequence(0, size(s) - 1),
                        i -> st.run[i] < s[i].parts AND (st.run[i] * b) div s[i].parts <= t),
                 i -> struct(((st.run[i] + 1L) * b + s[i].parts - 1L) div s[i].parts AS due, i AS i))).i),
              p -> named_struct('run', transform(st.run, (n, i) -> if(i = p, n + 1L, n)),
                                'out', concat(st.out, array(p))))[0],
          st -> st.out)"""))
    slots = lists.select("s", "b", F.posexplode("picked").alias("at", "i"))
    slots = slots.select(F.expr("s[i].key").alias("key"), F.expr("s[i].parts").alias("parts"),
                         F.col("b").alias("period"), F.col("at").cast("long").alias("at"))
    j = F.row_number().over(Window.partitionBy("key").orderBy("at")) - 1
    return slots.withColumn("j", j.cast("long"))


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def schedule(docs: DataFrame, weights: DataFrame | None = None, block_rows: int = BLOCK_ROWS,
             seed: str = SEED, carry: bool = False) -> DataFrame:
    """doc_id, source, block, release, deadline, slot, place, in_mix per row; with ``carry``
    every column of ``docs`` as one struct ``_doc`` as well. ``weights(source, parts)`` are
    integer parts for every source; by default :func:`smoothed_parts`."""
    key = _key(docs["source"])
    sizes = docs.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    parts = smoothed_parts(sizes) if weights is None else sizes.join(
        weights.select(_key(weights["source"]).alias("key"), weights["parts"].cast("long").alias("parts")), "key")
    period = one_period(parts.select("key", "parts"))
    ends = parts.join(period, ["key", "parts"]).groupBy("key").agg(
        F.max("n").alias("n"), F.max("parts").alias("parts"), F.max("period").alias("period"),
        F.map_from_entries(F.collect_list(F.struct("j", "at"))).alias("at"))  # at most B entries in all
    blocks = F.floor((F.col("n") + block_rows - 1) / block_rows).cast("long")
    # the slot that the source's first missing block would have had
    dry = F.expr("(blocks div parts) * period + at[blocks % parts]")
    ends = ends.withColumn("blocks", blocks).withColumn("dry", dry)
    ends = ends.withColumn("horizon", F.min("dry").over(Window.partitionBy(F.lit(1))))
    ends = materialize(ends, "mix_period")  # one row per source, read by three joins

    text = docs["text"].cast("string")
    row = docs.select(
        key.alias("key"), docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
        F.md5(F.concat(F.lit(seed), F.coalesce(docs["doc_id"].cast("string"), F.lit(""))).cast("binary")).alias("_h"),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("_t"),
        *([F.struct(*[docs[c] for c in docs.columns]).alias("_doc")] if carry else []))
    # rank inside a source: slices of its hash order, ranked one by one, plus the rows of earlier slices
    cells = row.join(F.broadcast(ends.select("key", "n")), "key")  # one row per source
    def share(hashed):
        return f"cast(conv(substr({hashed}, 1, 8), 16, 10) as bigint) * (n div {SLICE_ROWS} + 1) div 4294967296"

    # rows without an id share one hash: they are sliced on by their text
    void = F.md5(F.lit(seed).cast("binary"))
    cells = cells.withColumn("_slice", F.struct(
        F.expr(share("_h")).alias("by_id"), (F.col("_h") >= void).cast("int") + (F.col("_h") > void).cast("int"),
        F.when(F.col("_h") == void, F.expr(share("_t"))).alias("by_text")))
    before = Window.partitionBy("key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = cells.groupBy("key", "_slice").count().select(
        "key", "_slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    at = F.row_number().over(Window.partitionBy("key", "_slice").orderBy("_h", "doc_id", "_t"))
    ranked = cells.withColumn("_at", at).join(counts, ["key", "_slice"]).withColumn(
        "_rank", F.col("_at") + F.col("_before") - 1)
    out = ranked.drop("n").join(F.broadcast(ends), "key").withColumn(
        "block", F.expr(f"_rank div {block_rows}")).select(
        "doc_id", "source", F.col("block"),
        F.expr("(block * period) div parts").alias("release"),
        F.expr("((block + 1) * period + parts - 1) div parts").alias("deadline"),
        F.expr("(block div parts) * period + at[block % parts]").alias("slot"),
        F.expr(f"cast(_rank % {block_rows} as int)").alias("place"),
        "horizon", *(["_doc"] if carry else []))
    return out.withColumn("in_mix", F.col("slot") < F.col("horizon")).drop("horizon")


def op7(spark, sf_dir: str) -> DataFrame:
    return schedule(read_table(spark, sf_dir, "documents"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents in mixed order: sorted by (slot, place) over the whole
    result, so every written file holds a stretch of the mix (``sharding.shard_documents``
    goes through them in their order)."""
    out = schedule(docs, carry=True)
    parts = max(STRETCHES, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out = out.repartitionByRange(parts, "slot", "place").sortWithinPartitions("slot", "place")
    return out.select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])


OP7_SQL = f"""
WITH RECURSIVE counted AS (
  SELECT coalesce('=' || source, '') AS k, count(*) AS n FROM documents GROUP BY 1),
parts AS (
  SELECT k, n, greatest(1, round(greatest({RESOLUTION}::DOUBLE, ceil(whole / smallest - 1e-6))
         * (pow(n::DOUBLE, {ALPHA}::DOUBLE) / whole)))::BIGINT AS a
  FROM counted, (SELECT sum(pow(n::DOUBLE, {ALPHA}::DOUBLE)) AS whole, min(pow(n::DOUBLE, {ALPHA}::DOUBLE)) AS smallest
                 FROM counted)),
lists AS (
  SELECT list(k ORDER BY k) AS ks, list(a ORDER BY k) AS la, sum(a)::BIGINT AS b,
         list_transform(list(a ORDER BY k), lambda x: 0::BIGINT) AS zero FROM parts),
edf AS (
  SELECT -1::BIGINT AS t, zero AS run, 0::BIGINT AS p FROM lists
  UNION ALL
  SELECT t + 1, list_transform(run, lambda x, i: x + CASE WHEN i = q THEN 1 ELSE 0 END), q
  FROM (SELECT t, run, list_sort(list_filter(
          list_transform(run, lambda x, i: {{'due': ((x + 1) * b + la[i] - 1) // la[i], 'i': i::BIGINT}}),
          lambda s: run[s.i] < la[s.i] AND (run[s.i] * b) // la[s.i] <= t + 1))[1].i AS q
        FROM edf, lists WHERE t + 1 < b)),
one AS (
  SELECT ks[p] AS k, t AS pos, row_number() OVER (PARTITION BY p ORDER BY t) - 1 AS j
  FROM edf, lists WHERE t >= 0),
ends AS (
  SELECT k, a, b, (nb // a) * b + pos AS dry FROM (SELECT k, a, (n + {BLOCK_ROWS} - 1) // {BLOCK_ROWS} AS nb FROM parts)
  JOIN one USING (k) CROSS JOIN lists WHERE j = nb % a),
ranked AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS k,
         row_number() OVER (PARTITION BY source ORDER BY md5('{SEED}' || coalesce(doc_id::VARCHAR, '')), doc_id,
                            md5(coalesce(text, ''))) - 1 AS r FROM documents)
SELECT doc_id, source, (r // {BLOCK_ROWS})::BIGINT AS block,
       ((r // {BLOCK_ROWS}) * b) // a AS release,
       ((r // {BLOCK_ROWS} + 1) * b + a - 1) // a AS deadline,
       ((r // {BLOCK_ROWS}) // a) * b + pos AS slot, (r % {BLOCK_ROWS})::INTEGER AS place,
       ((r // {BLOCK_ROWS}) // a) * b + pos < (SELECT min(dry) FROM ends) AS in_mix
FROM ranked JOIN ends USING (k) JOIN one ON one.k = ranked.k AND one.j = (r // {BLOCK_ROWS}) % a
"""
