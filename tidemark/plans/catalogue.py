"""Registry of the core queries and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import mirror_queries, sql_queries

Query = Callable[[SparkSession, str], DataFrame]
flagship = mirror_queries.flagship


def queries() -> dict[str, Query]:
    return dict(mirror_queries.QUERIES) | sql_queries.queries()


def oracle_sql() -> dict[str, str]:
    return dict(mirror_queries.ORACLE) | sql_queries.oracle_sql()
