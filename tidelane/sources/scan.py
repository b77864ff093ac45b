"""Reading a source: whole, or only the rows past a cursor, plus the text form cursors are kept in."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Cursor(NamedTuple):
    """A cursor value as text with the Spark type it is cast back to.

    Text keeps 64-bit integers, decimals and microseconds exact wherever the ledger is stored.
    """

    value: str
    type: str


def encode_cursor(column: Column, dtype: T.DataType) -> Column:
    """A cursor column as text; instants are kept as microseconds, which no time zone setting alters."""
    return (F.unix_micros(column) if isinstance(dtype, T.TimestampType) else column).cast("string")


def decode_cursor(text: Column, type_name: str) -> Column:
    """Text back to a typed column."""
    if type_name == "timestamp":
        return F.timestamp_micros(text.cast("bigint"))
    return text.cast(type_name)


def cursor_literal(value: Any) -> Column:
    """A literal of the cursor's own type, so that the comparison reaches the scan without a cast."""
    if isinstance(value, Cursor):
        return decode_cursor(F.lit(value.value), value.type)
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(" ")).cast("timestamp_ntz")
    if isinstance(value, (dt.date, Decimal, int, float, str)):
        return F.lit(value)
    raise TypeError(f"not a cursor value: {value!r}")


def full_scan(df: DataFrame) -> DataFrame:
    """All rows and columns. Row order is no part of the result, so nothing is sorted."""
    return df


def incremental_scan(df: DataFrame, cursor: str, after: Any = None, lookback: Any = None) -> DataFrame:
    """Rows whose cursor is strictly past ``after``.

    Without a cursor value (a first run) there is no filter, so rows with a NULL cursor are read once;
    later runs never see them. ``lookback`` (a number, or a ``timedelta``) re-reads an overlap to catch
    rows that were committed late with an old cursor; the repeats are left to ``latest_rows``.
    """
    if after is None:
        return df
    bound = cursor_literal(after)
    if lookback is not None:
        bound = bound - F.lit(lookback)
    return df.where(F.col(cursor) > bound)


def _digest_text(df: DataFrame, key: str) -> Column:
    """A column as text that stays the same when its type is widened."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.DateType):
        return F.col(key).cast("timestamp_ntz").cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        number = F.col(key).cast("double") if isinstance(kind, T.FloatType) else F.col(key)
        return F.regexp_replace(number.cast("string"), r"\.0+$|(\.[0-9]*[1-9])0+$", "$1")
    return F.col(key).cast("string")


def row_digest(df: DataFrame, keys: list[str]) -> Column:
    """``digest``: 128 bits of some columns, by which rows of one cursor value are told apart."""
    texts = F.struct(*(_digest_text(df, k).alias(f"k{i}") for i, k in enumerate(keys)))
    return F.unhex(F.md5(F.to_json(texts, {"ignoreNullFields": "false"}))).alias("digest")


def tie_safe_scan(df: DataFrame, cursor: str, after: Any, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows past ``after``, and those at ``after`` itself whose digest of ``keys`` is not among ``seen`` (column ``digest``).

    Only the rows at the one value are joined; both filters reach the scan. Where the cursor has many ties, Spark joins by
    shuffle, else it broadcasts the digests by its own size check.
    """
    bound = cursor_literal(after)
    ties = df.where(F.col(cursor) == bound)
    known = seen.select(F.col("digest").alias("_seen"))
    late = ties.withColumn("_digest", row_digest(ties, keys)).join(known, F.col("_digest") == F.col("_seen"), "left_anti").drop("_digest")
    return df.where(F.col(cursor) > bound).unionAll(late)


def max_cursor(df: DataFrame, cursor: str, old: Any = None, alias: str = "max_cursor") -> DataFrame:
    """Largest non-NULL cursor; the old value when there is none, so that a cursor never turns NULL."""
    best = F.max(cursor)
    if old is not None:
        best = F.coalesce(best, cursor_literal(old))
    return df.agg(best.alias(alias))
