"""All queries and the SQL of each one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from atmolake.registry import core, landing, relations, scalars, staging, storage  # noqa: F401
from atmolake.registry.base import ORACLES, QUERIES, with_ctes


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in ORACLES.items()}
