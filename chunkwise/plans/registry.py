"""Registered queries: a Spark builder and an independent DuckDB SQL oracle per key.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables. Oracle SQL runs in DuckDB on the same Parquet files (tables are
pre-registered as views); column names match the Spark output.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    build: Builder
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql)
        return fn

    return deco
