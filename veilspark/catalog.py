"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame.

Each entry is one operator or report of the governance workload run over the
whole derived tables; ``sql_oracle.py`` holds the independent DuckDB twin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # Import the modules that register queries.
    from . import queries_masking, queries_audit, queries_meta, queries_extra  # noqa: F401
    return dict(QUERIES)
