"""Source/sink round trips (A1-A8). Writes go to fresh folders under the
shared folder named by ``spark.checkpoint.dir``; each query returns what
Spark reads back from the written files, to compare with the oracle.

Bank fixture: ``benchmark`` with id = item_id % 10 and pos = item_id div 10; every
text gets leading blanks and a U+0085 (no line end to us); id 10 holds 300 copies
of the whole bank, numbered, so it has more than 10,000 texts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.plans import fixtures as X
from colloquy.plans.registry import query
from colloquy.plans.state_queries import FACT_COLUMNS, FACTS_SQL, facts
from colloquy.session import scratch_path
from colloquy.sources import banks as A

ITEMS = ["click", "error", "purchase", "signup", "view"]
COPIES = 300


def _bank(spark, sf_dir):
    b = X.benchmark(spark, sf_dir).select("item_id", F.concat(F.lit("  "), "text", F.lit("\u0085x ")).alias("text"))
    small = b.select((F.col("item_id") % 10).alias("id"), (F.col("item_id") / 10).cast("bigint").alias("pos"), "text")
    large = b.select("item_id", "text", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("i")).select(
        F.lit(10).cast("bigint").alias("id"), (F.col("item_id") * COPIES + F.col("i")).alias("pos"),
        F.concat("text", F.col("i").cast("string")).alias("text"))
    return small.unionByName(large)


_BANK_SQL = f"""SELECT item_id % 10 AS id, item_id // 10 AS pos, '  ' || text || chr(133) || 'x ' AS text FROM benchmark
  UNION ALL SELECT 10, item_id * {COPIES} + i, '  ' || text || chr(133) || 'x ' || i::VARCHAR
  FROM benchmark, range(0, {COPIES}) r(i)"""
_DENSE_SQL = f"SELECT id, row_number() OVER (PARTITION BY id ORDER BY pos) AS pos, text FROM ({_BANK_SQL})"
_REPAIRED_SQL = "replace(translate(text, chr(146) || chr(128) || chr(160), '''€ '), chr(156), 'oe')"
_CLEAN_SQL = f"regexp_replace({_REPAIRED_SQL}, '[\\r\\n]+', ' ', 'g')"


@query("a1_read_bank", "A1", f"SELECT id::INTEGER AS id, text FROM ({_BANK_SQL})")
def a1(spark, sf_dir):
    path = scratch_path(spark, "bank-csv")
    A.write_bank(_bank(spark, sf_dir), path)
    return A.read_bank(spark, path).select("id", "text")


@query("a2_read_grouped_json", "A2", f"""
SELECT id::VARCHAR AS id, pos, text FROM ({_DENSE_SQL})""")
def a2(spark, sf_dir):
    path = scratch_path(spark, "grouped-json")
    A.write_grouped_json(_bank(spark, sf_dir), path, block_rows=500)
    return A.read_grouped_json(spark, path)


@query("a3_write_grouped_json", "A3", f"SELECT id::VARCHAR AS id, pos, text FROM ({_DENSE_SQL})")
def a3(spark, sf_dir):
    path = scratch_path(spark, "grouped-json")
    A.write_grouped_json(_bank(spark, sf_dir), path)
    return A.read_grouped_json(spark, path)


@query("a4_emit_training_blocks", "A4", f"""
SELECT id::VARCHAR AS id, pos, {_CLEAN_SQL} AS text FROM ({_DENSE_SQL})""")
def a4(spark, sf_dir):
    path = scratch_path(spark, "training")
    A.emit_training_blocks(_bank(spark, sf_dir), path)
    back = A.read_training_blocks(spark, path)
    return back.select(F.replace("intent", F.lit(A.INTENT_PREFIX), F.lit("")).alias("id"), "pos", "text")


@query("a5_emit_response_blocks", "A5", f"""
SELECT 'utter_faq/' || id::VARCHAR AS response, pos, {_REPAIRED_SQL} AS text FROM ({_DENSE_SQL})""")
def a5(spark, sf_dir):
    path = scratch_path(spark, "responses")
    A.emit_response_blocks(_bank(spark, sf_dir), path)
    return A.read_response_blocks(spark, path)


@query("a6_read_training_blocks", "A6", f"""
SELECT 'faq/' || id::VARCHAR AS intent, pos, {_CLEAN_SQL} AS text FROM ({_DENSE_SQL})""")
def a6(spark, sf_dir):
    path = scratch_path(spark, "training")
    A.emit_training_blocks(_bank(spark, sf_dir), path, block_rows=500)
    return A.read_training_blocks(spark, path)


@query("a7_feedback_roundtrip", "A7", f"SELECT * EXCLUDE (opened_ts, filled_ts) FROM ({FACTS_SQL})")
def a7(spark, sf_dir):
    path = scratch_path(spark, "feedback")
    rows = facts(spark, sf_dir).withColumn("fact_day", F.substring("time_user_question", 1, 10))
    for _ in range(2):  # the second append of a key changes nothing
        A.append_feedback(rows, path, partition_col="fact_day", key="facts")
    return A.read_feedback(spark, path, FACT_COLUMNS)


@query("a8_read_item_matrix", "A8", """
SELECT DISTINCT 'user' || user_id::VARCHAR AS role, event_type AS item FROM events""")
def a8(spark, sf_dir):
    ev = X.events(spark, sf_dir, "user_id", "event_type")
    wide = (ev.groupBy(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("role"))
            .pivot("event_type", ITEMS).agg(F.lit(1)).fillna(0, subset=ITEMS))
    path = scratch_path(spark, "item-matrix")
    A.write_item_matrix(wide, path)
    return A.read_item_matrix(spark, path, "role")
