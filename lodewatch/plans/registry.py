"""Registry of the queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodewatch.plans.universe import Universe

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of a `Universe` under `name`, with its checking SQL if there is one."""

    def register(build: Callable[[Universe], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Universe(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register
