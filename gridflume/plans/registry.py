"""Every query of the library by name, each with its DuckDB twin where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` gives the same rows in DuckDB."""

    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered already")
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return put


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def load() -> None:
    """Import the modules that register queries."""
    from . import bundle_queries, catalogue_queries, gap_queries, grid_queries, month_queries, normalize_queries, publication_queries, reconcile_queries, record_queries, refresh_queries, repair_queries, release_queries, selection_queries, stream_queries, temporal_queries  # noqa: F401


load()
