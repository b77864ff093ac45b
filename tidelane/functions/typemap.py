"""Mappings between source types, canonical types and destination types, as columns and small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Source type numbers and their canonical types (17 scalars, then 16 arrays by item).
SCALAR_OIDS = {
    16: "BOOL", 17: "BYTES", 20: "INT64", 21: "INT64", 23: "INT64", 25: "STRING", 114: "JSON",
    700: "FLOAT64", 701: "FLOAT64", 1042: "STRING", 1043: "STRING", 1082: "DATE", 1114: "TIMESTAMP",
    1184: "TIMESTAMP", 1700: "NUMERIC", 2950: "STRING", 3802: "JSON",
}
ARRAY_OIDS = {
    199: "JSON", 1000: "BOOL", 1001: "BYTES", 1005: "INT64", 1007: "INT64", 1009: "STRING",
    1015: "STRING", 1016: "INT64", 1021: "FLOAT64", 1022: "FLOAT64", 1115: "TIMESTAMP", 1182: "DATE",
    1185: "TIMESTAMP", 1231: "NUMERIC", 2951: "STRING", 3807: "JSON",
}
# Source type names and their canonical types.
TYPE_NAMES = {
    "boolean": "BOOL", "bool": "BOOL", "smallint": "INT64", "integer": "INT64", "int": "INT64",
    "bigint": "INT64", "bigserial": "INT64", "real": "FLOAT64", "double precision": "FLOAT64",
    "numeric": "NUMERIC", "decimal": "NUMERIC", "text": "STRING", "character varying": "STRING",
    "character": "STRING", "varchar": "STRING", "char": "STRING", "uuid": "STRING",
    "timestamp without time zone": "TIMESTAMP", "timestamp with time zone": "TIMESTAMP",
    "date": "DATE", "json": "JSON", "jsonb": "JSON", "bytea": "BYTES",
}
# Canonical scalar types and the destination's names for them.
DESTINATION_TYPES = {
    "STRING": "STRING", "INT64": "INTEGER", "FLOAT64": "FLOAT", "NUMERIC": "NUMERIC", "BOOL": "BOOLEAN",
    "TIMESTAMP": "TIMESTAMP", "DATE": "DATE", "JSON": "JSON", "BYTES": "BYTES",
}
# For each destination type, the source types it may be widened to without loss of meaning.
WIDENINGS = {
    "INT64": ("FLOAT64", "NUMERIC", "STRING"),
    "FLOAT64": ("NUMERIC", "STRING"),
    "NUMERIC": ("STRING",),
    "BOOL": ("STRING",),
    "DATE": ("TIMESTAMP", "STRING"),
    "TIMESTAMP": ("STRING",),
}


#: Types by how much they hold: what a type widens to comes after it.
TYPE_ORDER = ("BOOL", "INT64", "DATE", "FLOAT64", "TIMESTAMP", "NUMERIC", "JSON", "BYTES", "REPEATED", "STRING")


def _mask(kinds) -> int:
    return sum(1 << TYPE_ORDER.index(k) for k in kinds)


def reachable(kind: Column) -> Column:
    """The types a column of type ``kind`` may have or be widened to, as bits; an unknown type is a string."""
    bits = F.lit(_mask(["STRING"]))
    for name in TYPE_ORDER:
        bits = F.when(kind == name, F.lit(_mask([name, *WIDENINGS.get(name, ())]))).otherwise(bits)
    return bits


def narrowest(bits: Column) -> Column:
    """The type that holds least among some types; null if there is none."""
    found = F.lit(None).cast("string")
    for name in reversed(TYPE_ORDER):
        found = F.when(bits.bitwiseAND(_mask([name])) != 0, F.lit(name)).otherwise(found)
    return found


def is_widening(old: Column, new: Column) -> Column:
    """Whether a destination column of type ``old`` may become type ``new``."""
    allowed = F.lit(False)
    for narrow, wider in WIDENINGS.items():
        allowed = F.when(old == narrow, new.isin(*wider)).otherwise(allowed)
    return F.coalesce(allowed, F.lit(False))


def widens(old: str, new: str) -> bool:
    """The same rule for two type names on the driver."""
    return new in WIDENINGS.get(old, ())


def _lookup(spark: SparkSession, key: str, rows: list[str]) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS m({key}, mapped_type, mapped_item)")


def _with_mapping(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    # The lookup holds a few dozen fixed rows, so broadcasting it is bounded whatever the data.
    return (
        df.join(F.broadcast(lookup), key, "left")
        .withColumn("type", F.coalesce("mapped_type", F.lit("STRING")))
        .withColumn("item_type", F.col("mapped_item"))
        .withColumn("known", F.col("mapped_type").isNotNull())
        .drop("mapped_type", "mapped_item")
    )


def map_source_types(df: DataFrame, oid: str = "type_oid") -> DataFrame:
    """Add ``type``, ``item_type`` and ``known`` for a source type number; unknown ones are STRING."""
    rows = [f"({n}L, '{t}', CAST(NULL AS STRING))" for n, t in SCALAR_OIDS.items()]
    rows += [f"({n}L, 'REPEATED', '{t}')" for n, t in ARRAY_OIDS.items()]
    lookup = _lookup(df.sparkSession, oid, rows)
    return _with_mapping(df.withColumn(oid, F.col(oid).cast("bigint")), lookup, oid)


def map_source_type_names(df: DataFrame, name: str = "type_name") -> DataFrame:
    """The same from a type name, where ``xxx[]`` is an array of the known type ``xxx``.

    An array of arrays has REPEATED items: its base name is itself an array's name.
    """
    base = "_base_name"
    lookup = _lookup(df.sparkSession, base, [f"('{n}', '{t}', CAST(NULL AS STRING))" for n, t in TYPE_NAMES.items()])
    depth = F.floor((F.length(name) - F.length(F.regexp_replace(name, r"(\[\])+$", ""))) / 2)
    mapped = _with_mapping(
        df.withColumn(base, F.regexp_replace(name, r"(\[\])+$", "")).withColumn("_depth", depth), lookup, base
    )
    array = F.col("known") & (F.col("_depth") > 0)
    item = F.when(F.col("_depth") == 1, F.col("type")).otherwise("REPEATED")
    return (
        mapped.withColumn("item_type", F.when(array, item))
        .withColumn("type", F.when(array, "REPEATED").otherwise(F.col("type")))
        .drop(base, "_depth")
    )


def destination_type(kind: Column, item: Column) -> tuple[Column, Column]:
    """Destination type name and mode part of a canonical type: ``(type, is_repeated)``."""
    repeated = kind == "REPEATED"
    scalar = F.when(repeated, item).otherwise(kind)
    named = F.lit("STRING")
    for canonical, destination in DESTINATION_TYPES.items():
        named = F.when(scalar == canonical, destination).otherwise(named)
    return named, repeated


def to_destination_columns(rows: DataFrame) -> DataFrame:
    """Schema-rows to destination columns: ``dest_type`` and ``mode``.

    An array is REPEATED whatever its nullability; a non-null scalar is REQUIRED.
    """
    named, repeated = destination_type(F.col("type"), F.col("item_type"))
    mode = F.when(repeated, "REPEATED").when(F.col("nullable"), "NULLABLE").otherwise("REQUIRED")
    return rows.withColumn("dest_type", named).withColumn("mode", mode)


def from_destination_columns(columns: DataFrame) -> DataFrame:
    """Destination columns (``dest_type``, ``mode``) back to ``type``, ``item_type`` and ``nullable``."""
    scalar = F.lit("STRING")
    for canonical, destination in DESTINATION_TYPES.items():
        scalar = F.when(F.col("dest_type") == destination, canonical).otherwise(scalar)
    repeated = F.col("mode") == "REPEATED"
    return (
        columns.withColumn("type", F.when(repeated, "REPEATED").otherwise(scalar))
        .withColumn("item_type", F.when(repeated, scalar))
        .withColumn("nullable", F.col("mode") != "REQUIRED")
    )
