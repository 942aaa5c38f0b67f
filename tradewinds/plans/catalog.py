"""Registry of named queries and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query; ``oracle`` is the SQL that must give the same rows."""

    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def load_all() -> None:
    import importlib
    for area in ("trade", "risk", "behavior", "news", "quality", "learn", "source", "gold"):
        importlib.import_module(f"tradewinds.plans.{area}_queries")
