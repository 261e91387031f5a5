"""Domain tables derived from the driver tables.

Every function reads the given parquet tables and derives its rows with
Spark expressions, so the work grows with the tables. Column selections
are explicit so the parquet scans read only what is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.session import read_table

# --- fixed values of the fixture mapping ----------------------------------
# event_type -> intent used by the state, profile and form fixtures
PROFILE_INTENTS = {"click": "short_utters", "view": "long_utters", "purchase": "dont_care"}
# Rating intents: the form accepts text from intent "number", not from these
EXCLUDED_FORM_INTENTS = ["faq", "deny", "ask_reformulate"]
# ---------------------------------------------------------------------------


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


def events(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Events with ``k`` (0..99 from props) and ``day`` (``yyyy-MM-dd`` text)."""
    ev = read_table(spark, sf_dir, "events")
    ev = ev.withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumn(
        "day", F.date_format("ts", "yyyy-MM-dd"))
    return ev.select(*cols) if cols else ev


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    return d.select(*cols) if cols else d


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "benchmark").select("item_id", "text")


def ranking_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking as rows: request = (user_id, day); candidate key ``faq/<event_id>``
    with confidence k/100; rank by k desc, event_id."""
    from colloquy.operators.intents import rank_candidates

    ev = events(spark, sf_dir, "user_id", "day", "event_id", "k")
    cands = ev.select(
        "user_id", "day", "event_id",
        F.concat(F.lit("faq/"), F.col("event_id").cast("string")).alias("key"),
        (F.col("k").cast("double") / F.lit(100.0)).alias("confidence"),
    )
    return rank_candidates(cands, ["user_id", "day"], order=[F.col("confidence").desc(), F.col("event_id")])


def slot_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot writes: slot = event_type, value = value; ``error`` resets ``click``."""
    ev = events(spark, sf_dir, "user_id", "ts", "event_id", "event_type", "value")
    return ev.select(
        F.col("user_id").alias("conv_id"), "ts", F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", F.lit("click")).otherwise(F.col("event_type")).alias("slot"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .otherwise(F.col("value").cast("string")).alias("value"),
    )


def user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation profile from the user's own texts: average length of the
    user turns < 150 gives short, > 400 long, else no profile."""
    conv = conversations(spark, sf_dir)
    avg = conv.filter(F.col("role") == "user").groupBy("conv_id").agg(F.avg(F.char_length("text")).alias("avg_len"))
    return avg.select(
        "conv_id",
        F.when(F.col("avg_len") < 150, F.lit("short_utters"))
        .when(F.col("avg_len") > 400, F.lit("long_utters")).alias("profile"),
    )
