"""Registry of the queries, the survey rows they cover and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    covers: tuple[str, ...]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function under its own name; ``covers`` lists the survey rows it shows."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[function.__name__] = Query(function, tuple(covers.split()), sql)
        return function

    return register
