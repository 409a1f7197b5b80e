"""Registry of queries and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from penprint.session import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
FIXTURES: list[Callable[[SparkSession, str], DataFrame]] = []


def check(sql: str | None = None):
    """Register a query under its function name, with its SQL where there is one."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fixture(build):
    """An input made from the tables, written once per application and folder."""
    made: dict[tuple[str, str], DataFrame] = {}

    @functools.wraps(build)
    def get(spark: SparkSession, folder: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, folder)
        if key not in made:
            made[key] = staged(build(spark, folder), build.__name__)
        return made[key]

    FIXTURES.append(get)
    return get
