"""All queries and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliospark.plans import catalog_queries, core_problems, embedding_queries, extraction_queries, validator_queries

MODULES = (core_problems, catalog_queries, extraction_queries, embedding_queries, validator_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
