"""Query registry: one callable (spark, sf_dir) -> DataFrame per operator key
fixture views (no id subsets, no row caps)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    """Register a query under `name`."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


def all_queries() -> dict[str, QueryFn]:
    # importing the modules registers their queries
    from zonecast.plans import (queries_columns, queries_demand,  # noqa: F401
                                queries_explore, queries_io, queries_models)
    return dict(QUERIES)
