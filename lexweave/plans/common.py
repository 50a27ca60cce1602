"""A registry of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """tables.documents and so on: the Parquet tables of a folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def registrar(queries: dict[str, Query], sql: dict[str, str]):
    def register(oracle: str | None = None, name: str | None = None):
        def wrap(f: Callable[[Tables], DataFrame]):
            key = name or f.__name__
            queries[key] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
            if oracle:
                sql[key] = oracle
            return f

        return wrap

    return register
