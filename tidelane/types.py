"""The ten canonical column types and their two-way mapping to Spark types.

A *schema-rows* DataFrame holds one row per column of any number of tables, so that schemas can be
compared and joined like other data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.frames import small_frame

# Canonical type names.
CANONICAL_TYPES = (
    "STRING", "INT64", "FLOAT64", "BOOL", "TIMESTAMP", "DATE", "NUMERIC", "JSON", "BYTES", "REPEATED",
)

SCHEMA_ROWS = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("item_type", T.StringType()),
    T.StructField("nullable", T.BooleanType()),
])

DEFAULT_NUMERIC = T.DecimalType(38, 9)
_JSON_TAG = {"canonical": "JSON"}

_TO_SPARK = {
    "STRING": T.StringType(),
    "INT64": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "BOOL": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "NUMERIC": DEFAULT_NUMERIC,
    "JSON": T.StringType(),
    "BYTES": T.BinaryType(),
}


def _scalar(dtype: T.DataType) -> str | None:
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "INT64"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "FLOAT64"
    if isinstance(dtype, T.DecimalType):
        return "NUMERIC"
    if isinstance(dtype, T.BooleanType):
        return "BOOL"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(dtype, T.DateType):
        return "DATE"
    if isinstance(dtype, T.BinaryType):
        return "BYTES"
    if isinstance(dtype, T.VariantType):
        return "JSON"
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "STRING"
    return None


def canonical(field: T.StructField) -> tuple[str, str | None]:
    """``(type, item_type)`` of a Spark column; what has no counterpart is a STRING."""
    dtype = field.dataType
    if isinstance(dtype, T.ArrayType):
        item = _scalar(dtype.elementType)
        return ("REPEATED", item) if item else ("STRING", None)
    kind = _scalar(dtype) or "STRING"
    if kind == "STRING" and (field.metadata or {}).get("canonical") == "JSON":
        return "JSON", None
    return kind, None


def spark_type(kind: str, item: str | None = None) -> T.DataType:
    """Spark type that stores a canonical type; an unknown name is stored as a string."""
    if kind == "REPEATED":
        return T.ArrayType(_TO_SPARK.get(item, T.StringType()))
    return _TO_SPARK.get(kind, T.StringType())


def _stored_type(dtype: T.DataType) -> T.DataType:
    # Decimal precision and the time zone flavour of timestamps are the source's and are kept.
    if isinstance(dtype, (T.DecimalType, T.TimestampType, T.TimestampNTZType)):
        return dtype
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_stored_type(dtype.elementType)) if _scalar(dtype.elementType) else T.StringType()
    return _TO_SPARK[_scalar(dtype) or "STRING"]


def stored_field(field: T.StructField) -> T.StructField:
    """The destination column for a source column: canonical type, always nullable."""
    is_json = canonical(field)[0] == "JSON"
    return T.StructField(field.name, _stored_type(field.dataType), True, _JSON_TAG if is_json else None)


def stored_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([stored_field(f) for f in schema.fields])


def as_json(column: str, alias: str | None = None) -> Column:
    """Mark a string column as JSON text, so that it is treated as the JSON canonical type."""
    return F.col(column).alias(alias or column, metadata=_JSON_TAG)


def schema_rows(spark: SparkSession, schemas: Mapping[str, T.StructType]) -> DataFrame:
    """Schema-rows of the given tables. Only metadata passes through the driver."""
    rows = [
        dict(zip(SCHEMA_ROWS.names, (table, position, f.name, *canonical(f), f.nullable)))
        for table, schema in schemas.items()
        for position, f in enumerate(schema.fields, 1)
    ]
    return small_frame(spark, rows, SCHEMA_ROWS)


def schema_from_rows(rows: Iterable[Mapping]) -> T.StructType:
    """One table's schema-rows (as collected metadata) back to a ``StructType``."""
    ordered = sorted(rows, key=lambda r: r["ordinal"])
    return T.StructType([
        T.StructField(
            r["name"], spark_type(r["type"], r["item_type"]), bool(r["nullable"]),
            _JSON_TAG if r["type"] == "JSON" else None,
        )
        for r in ordered
    ])
