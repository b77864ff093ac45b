from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    """Register a query under its function's name, with the SQL that gives the same rows."""
    def add(query):
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query
    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def pick(values: list, number: str) -> Column:
    """The value at position ``number`` modulo the list's length; ``pick_sql`` is its SQL twin."""
    listed = ", ".join(map(repr, values))
    return F.expr(f"element_at(array({listed}), CAST(pmod({number}, {len(values)}) + 1 AS INT))")


def pick_sql(values: list, number: str) -> str:
    return f"list_extract([{', '.join(repr(v) for v in values)}], {number} % {len(values)} + 1)"
