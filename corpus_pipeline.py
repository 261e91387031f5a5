"""The corpus pipeline: stages over ``documents``, each reading all that its
predecessor kept, written as Parquet in between.

All stages but the last return the columns of ``documents``. The first three are
filters: documents without a recognisable language go, one document of each group of
near copies stays, documents that hold a benchmark item go. The fourth puts every
document left in mixed order and loses none, in files that are stretches of the mix; the
last deals them to shards, whose slots go through the stretches in that order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colloquy.llm.decontaminate import drop_leaks
from colloquy.llm.langid import fit, keep_identified
from colloquy.llm.minhash import drop_near_copies
from colloquy.llm.mixing import mix_documents
from colloquy.llm.sharding import shard_documents
from colloquy.session import configure, materialize, read_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the model is learned from the labelled rows among them."""
    configure(spark)
    return keep_identified(docs, fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    configure(spark)
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    configure(spark)
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources interleaved to their target weights; no document is lost."""
    configure(spark)
    return mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """40 shards of equal size, drawn uniformly (column shard); inside a shard the order of the
    mix, stretch by stretch, shuffled inside each (column slot)."""
    configure(spark)
    return shard_documents(docs)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix),
    ("shard", shard),
]

# Not expressible in SQL: stages fit models, hash by functions that SQL does not have
# and draw random numbers. tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
