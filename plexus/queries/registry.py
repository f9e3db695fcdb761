"""Registry of queries and of the SQL that states their result."""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

MODULES = ("catalog", "filters", "traversal", "aggregates", "ordering", "sets", "scalars",
           "similarity", "documents", "datasets", "provenance", "incremental")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its SQL where SQL can state the result."""
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def load_all() -> None:
    for module in MODULES:
        if importlib.util.find_spec(f"plexus.queries.{module}") is None:
            continue
        importlib.import_module(f"plexus.queries.{module}")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")
