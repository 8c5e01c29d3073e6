"""Register of checked queries: a Spark function and, where possible, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from equitrace.catalog.inputs import Inputs, rounded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, places: int = 6):
    """Register a query on the inputs of a data folder; doubles are rounded to `places`."""

    def add(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(Inputs(spark, sf_dir)), places)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
