"""Named queries: a Spark function over the given tables and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


class Tables:
    """The tables of one folder as attributes, each read lazily from Parquet."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def query(sql: str | None = None):
    """Register ``f(tables)`` under its own name."""
    def register(function: Callable[[Tables], DataFrame]):
        name = function.__name__
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            _sql[name] = sql
        return function
    return register


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def all_sql() -> dict[str, str]:
    return dict(_sql)
