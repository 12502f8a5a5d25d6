"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, derives its inputs from the given
tables (``plans.fixtures``) and returns a DataFrame whose columns carry the
same names as the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


def queries() -> dict[str, Builder]:
    _load()
    return {k: q.build for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: q.sql for k, q in REGISTRY.items() if q.sql is not None}


def _load() -> None:
    # Importing the modules registers their queries.
    from rivalry.plans import q_models, q_ingest, q_serve, q_quality, q_snapshot, q_resolve  # noqa: F401
