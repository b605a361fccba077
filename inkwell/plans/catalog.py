"""Where queries register: a name, the operators that it covers, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, list[str]] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; ``covers`` lists inventory ids."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        COVERS[f.__name__] = covers.split()
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register
