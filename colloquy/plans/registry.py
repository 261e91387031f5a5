"""Registry of named queries over the driver tables.

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with the
equivalent DuckDB SQL (or ``None`` when the operator has no SQL form).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    operator: str


REGISTRY: dict[str, Query] = {}


def sql_lit(text: str) -> str:
    """A SQL string literal (single quotes doubled)."""
    return "'" + text.replace("'", "''") + "'"


def query(name: str, operator: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with its oracle SQL."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, operator)
        return fn

    return wrap


def load_all() -> dict[str, Query]:
    # importing the modules fills the registry
    from colloquy.plans import (  # noqa: F401
        answer_queries,
        corpus_queries,
        dialogue_queries,
        gate_queries,
        keyword_queries,
        path_queries,
        ranking_queries,
        recommend_queries,
        source_queries,
        state_queries,
        stream_queries,
        tagger_queries,
        text_queries,
    )

    return REGISTRY
