"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import table


class Tables:
    """The tables of a data directory as attributes."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("__"):
            raise AttributeError(name)
        return table(self.spark, self.directory, name)


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None = None):
        """Register f(tables) -> DataFrame under its name, with its oracle."""

        def wrap(f):
            self.queries[f.__name__] = lambda spark, d: f(Tables(spark, d))
            if sql:
                self.oracles[f.__name__] = sql
            return f

        return wrap
