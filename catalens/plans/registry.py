"""All queries of the catalog operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query of (spark, sf_dir) under ``name``, with the SQL of the same result."""

    def add(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def _load() -> None:
    from catalens.plans import catalog, facets, media, more, names, records, search, sources, stats, taxonomy, text  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
