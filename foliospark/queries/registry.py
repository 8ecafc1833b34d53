"""Where queries register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers ``f(table)`` under its name; ``table(name)`` reads one of the tables."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf: f(lambda name: spark.read.parquet(f"{sf}/{name}.parquet"))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add
