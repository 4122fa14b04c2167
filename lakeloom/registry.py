"""Queries with their DuckDB twins side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .sources.versions import scratch as scratch

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def twin(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers a query under its name, with its SQL where it has one."""

        def add(query: Query) -> Query:
            self.queries[query.__name__] = query
            if sql:
                self.sql[query.__name__] = sql
            return query

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
