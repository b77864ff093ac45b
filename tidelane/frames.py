"""Small DataFrames made from values on the driver: events, plans and schemas."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default JSON format keeps milliseconds only; events are ordered by microseconds.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def _plain(value):
    return value.isoformat(timespec="microseconds") if isinstance(value, dt.datetime) else str(value)


def small_frame(spark: SparkSession, rows: Iterable[Mapping], schema: T.StructType) -> DataFrame:
    """A few rows as one literal in the plan, which needs no Python worker to read back."""
    text = json.dumps([{f.name: row.get(f.name) for f in schema.fields} for row in rows], default=_plain)
    options = {**JSON_TIMES, "mode": "FAILFAST"}
    parsed = F.from_json(F.lit(text), T.ArrayType(schema), options)
    return spark.range(0, 1, 1, 1).select(F.inline(parsed))


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in the given columns; the optimizer drops whatever reads them."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata or {}) for f in schema.fields]
    return spark.range(0).select(columns)
