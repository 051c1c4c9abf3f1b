"""Query registry: key -> Spark builder (spark, sf_dir) -> DataFrame, plus the
equivalent DuckDB SQL over the driver tables (None = no SQL oracle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn`` under ``key`` with its oracle SQL."""

    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from granary.plans import (  # noqa: F401
        q_ingest, q_quality, q_schema, q_reshape, q_lineage, q_graph, q_ledger, q_html, q_io, q_stream,
    )
