"""Registered queries: a DataFrame builder and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        key = name or build.__name__
        if key in QUERIES:
            raise KeyError(f"query {key!r} is registered twice")
        QUERIES[key] = build
        if sql is not None:
            ORACLES[key] = sql.strip()
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
