"""Named queries of this subpackage and their DuckDB oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

MODULES = ("exact_dedup", "mixing", "line_dedup", "decontaminate", "toxicity", "quality", "ngram_join", "spans", "katz", "licences",
           "divergence", "runs", "langid")


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")
