"""Registry of named queries: each key maps to a Spark plan builder
``(spark, sf_dir) -> DataFrame`` and, where the semantics are expressible in
SQL, to an equivalent DuckDB oracle statement over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every key module (registration happens at import)."""
    from vigil.plans import (  # noqa: F401
        keys_clean, keys_fairness, keys_features, keys_ingest, keys_models, keys_profile,
        keys_quality)


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
