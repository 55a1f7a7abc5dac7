"""Registered queries with the SQL that has to give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortloom.checks.inputs import Inputs
from cohortloom.checks.sql import with_parts
from cohortloom.checks.table_sql import PARTS
from cohortloom.plans.settings import Settings
from cohortloom.session import tune

Query = Callable[[Inputs], DataFrame]
SETTINGS = Settings(secret="test_key")

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None, parts: dict[str, str] | None = None):
    """Register a query; extracts and ``parts`` the SQL names are put in front of it."""

    def register(query: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = query
        if sql is not None:
            _SQL[name] = with_parts(sql, PARTS | (parts or {}))
        return query

    return register


def _runner(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(Inputs(tune(spark), folder))

    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(query) for name, query in _QUERIES.items()}


def all_sql() -> dict[str, str]:
    return dict(_SQL)
