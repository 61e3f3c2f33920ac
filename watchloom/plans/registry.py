"""All queries of the engine with the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import aggregates, landed, relations, scalars, service

PARTS = [aggregates, relations, scalars, landed, service]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for part in PARTS for name, (query, _) in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in PARTS for name, (_, sql) in part.QUERIES.items() if sql}
