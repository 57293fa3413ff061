"""Queries by name, each with the SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import with_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, *tables: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL over the named domain tables."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = with_tables(sql, *tables) if tables else sql
        return f

    return register


from . import catalog, ingest, raster, scalars, selection, stages, streams, trends  # noqa: E402, F401  they register themselves
