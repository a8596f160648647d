"""Register a query under its name, with an optional SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lodeworks.queries.roles import Tables
from lodeworks.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """The decorated function gets ``Tables`` and returns a DataFrame."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(prepare(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
