"""Registered queries, each next to the SQL that gives the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loticote.session import tune_listings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
_registered: list[str] = []


def names() -> list[str]:
    """The queries of this package, without those that other packages add."""
    return sorted(_registered)


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return build(tune_listings(spark), sf)

        QUERIES[name] = run
        _registered.append(name)
        ORACLE[name] = sql
        return build

    return register
