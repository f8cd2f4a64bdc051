"""Registered queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..conf import tune
from .oracles import with_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL for it where SQL can say it."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: run(tune(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return run

    return register
