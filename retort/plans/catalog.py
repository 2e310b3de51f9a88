"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and the
matching DuckDB SQL (``None`` where only a row-count check applies)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from retort.plans import (  # noqa: F401
        q_clean,
        q_tags,
        q_tokens,
        q_patents,
        q_lookup,
        q_graph,
        q_vectors,
        q_similarity,
        q_sources,
        q_learn,
    )
