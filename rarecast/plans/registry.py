"""Registry of named queries (Spark callables) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is
    the DuckDB oracle (omitted for rows-only checked operators)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that it registers itself."""
    from . import (q_comments, q_sources, q_normalise, q_outcome, q_prep, q_profile,  # noqa: F401
                   q_priors, q_encode, q_text, q_resample, q_evaluate, q_models,
                   q_streaming)
