"""Operators over a source's own catalog, for registries too large to list on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelane.functions.typemap import map_source_types


def list_tables(tables: DataFrame, schema: str = "public") -> DataFrame:
    """Names of the base tables of one schema, from ``(table_schema, table_type, table_name)`` rows."""
    wanted = (F.col("table_schema") == schema) & (F.col("table_type") == "BASE TABLE")
    return tables.where(wanted).select("table_name")


def describe_schema(
    attributes: DataFrame, classes: DataFrame, namespaces: DataFrame, types: DataFrame, schema: str | None = "public"
) -> DataFrame:
    """Schema-rows of every table of a schema (all schemas for ``None``), from four catalog relations.

    ``attributes (attrelid, attname, atttypid, attnum, attnotnull, attisdropped)``,
    ``classes (class_oid, relname, relnamespace)``, ``namespaces (namespace_oid, nspname)``,
    ``types (type_oid)``. System and dropped columns are left out.
    """
    live = attributes.where((F.col("attnum") > 0) & ~F.col("attisdropped"))
    wanted = namespaces if schema is None else namespaces.where(F.col("nspname") == schema)
    tables = classes.join(wanted, classes["relnamespace"] == wanted["namespace_oid"])
    columns = (
        live.join(types.select("type_oid"), F.col("atttypid") == F.col("type_oid"))
        .join(tables, F.col("attrelid") == F.col("class_oid"))
        .select(
            F.col("nspname").alias("namespace"), F.col("relname").alias("table_name"),
            F.col("attnum").alias("ordinal"), F.col("attname").alias("name"),
            "type_oid", (~F.col("attnotnull")).alias("nullable"),
        )
    )
    return map_source_types(columns)
