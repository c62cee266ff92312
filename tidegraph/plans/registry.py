"""Every query on the star-schema tables, with the DuckDB SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator that files a query, and its oracle where SQL can express it."""

    def file(build):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = build
        if sql is not None:
            _SQL[name] = sql
        return build

    return file


def _load() -> None:
    """Import the modules that register queries; each files its own."""
    from tidegraph.plans import campaign, disclosures, domain, exchange, operations, ranking, relational, surface, text  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["edge_aggregate"](spark, sf_dir)
