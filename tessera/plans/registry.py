"""Registry of runnable queries over the driver tables.

Each query reads whole tables through :class:`tessera.session.Tables` and
returns a DataFrame whose columns carry the same names as its DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` with an optional oracle SQL."""

    def deco(fn):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return deco


def queries() -> dict[str, Callable]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
