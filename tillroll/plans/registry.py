"""Registry of named queries over the benchmark tables.

Each entry pairs a Spark plan ``(spark, sf_dir) -> DataFrame`` with the
DuckDB SQL that states the same result (or ``None`` where the operator is
checked by tests instead, e.g. a file-stream run).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: str


REGISTRY: dict[str, Query] = {}


def register(name: str, ops: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return deco
