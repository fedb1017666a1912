"""The register of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kessan.queries.bind import Tables, cte

_FUNCTIONS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, tuple[str, tuple[str, ...]]] = {}
#: Inventory ids each query covers.
COVERS: dict[str, tuple[str, ...]] = {}


def query(name: str, ids: str, sql: str | None = None, uses: str = ""):
    """Register ``fn(tables) -> DataFrame``. ``uses`` names the bound tables the SQL reads."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _FUNCTIONS:
            raise ValueError(f"{name} is registered twice")
        run = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        run.__module_name__ = fn.__module__.rsplit(".", 1)[-1]
        _FUNCTIONS[name] = run
        COVERS[name] = tuple(ids.split())
        if sql is not None:
            _SQL[name] = sql, tuple(uses.split())
        return fn

    return register


def _load() -> None:
    from kessan.queries import (  # noqa: F401
        aggregates,
        companies,
        facts,
        filings,
        jobs,
        scalars,
        storage,
    )


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_FUNCTIONS)


def all_sql() -> dict[str, str]:
    _load()
    return {name: (cte(*uses) if uses else "") + sql for name, (sql, uses) in _SQL.items()}
