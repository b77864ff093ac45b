"""Schema drift: compare, decide, evolve and align."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.functions.typemap import is_widening, narrowest, reachable, widens
from tidelane.types import canonical, stored_field

# Kinds of schema change.
ADD_COLUMN = "add_column"
REMOVE_COLUMN = "remove_column"
TYPE_WIDEN = "type_widen"
TYPE_INCOMPATIBLE = "type_incompatible"


class IncompatibleSchema(Exception):
    """A column changed in a way that could corrupt data; its table must not be loaded."""


def schema_diff(source: DataFrame, dest: DataFrame, strict_items: bool = False) -> DataFrame:
    """Changes that turn each destination table's schema into its source's, one row per column.

    Both inputs are schema-rows. A table the destination does not have is created, not changed, so it
    yields no rows. Item types of arrays are compared only with ``strict_items``.
    """
    existing = source.join(dest.select("table_name").distinct(), "table_name", "left_semi")
    new = existing.select(
        "table_name", "name", F.col("ordinal").alias("new_ordinal"), F.col("type").alias("new_type"),
        F.col("item_type").alias("new_item_type"),
    )
    old = dest.select(
        "table_name", "name", F.col("ordinal").alias("old_ordinal"), F.col("type").alias("old_type"),
        F.col("item_type").alias("old_item_type"),
    )
    kind = (
        F.when(F.col("old_type").isNull(), ADD_COLUMN)
        .when(F.col("new_type").isNull(), REMOVE_COLUMN)
        .when(
            F.col("old_type") != F.col("new_type"),
            F.when(is_widening(F.col("old_type"), F.col("new_type")), TYPE_WIDEN).otherwise(TYPE_INCOMPATIBLE),
        )
    )
    if strict_items:
        kind = kind.when(~F.col("old_item_type").eqNullSafe(F.col("new_item_type")), TYPE_INCOMPATIBLE)
    return (
        new.join(old, ["table_name", "name"], "full_outer")
        .withColumn("change_type", kind)
        .where(F.col("change_type").isNotNull())
        .select(
            "table_name", "name", "change_type", "old_type", "old_item_type", "new_type", "new_item_type",
            F.coalesce("new_ordinal", "old_ordinal").alias("ordinal"),
        )
    )


def common_types(rows: DataFrame) -> DataFrame:
    """One type for each column that all its versions can be widened to, over any number of versions or files.

    ``rows`` are schema-rows of every version. Gives ``table_name, name, type, item_type, versions, nullable``: the narrowest type
    allowed for all versions, null where there is none, so that the table has to be halted; likewise for the items of arrays. Which types are still
    possible is a set of bits, so versions are combined in any order, before the shuffle too. Null types are left out.
    """
    possible = F.bit_and(reachable(F.col("type"))).alias("_types")
    items = F.bit_and(F.when(F.col("type") == "REPEATED", reachable(F.coalesce("item_type", F.lit("STRING"))))).alias("_items")
    found = rows.where(F.col("type").isNotNull()).groupBy("table_name", "name").agg(
        possible, items, F.count(F.lit(1)).alias("versions"), F.bool_or("nullable").alias("nullable")
    )
    item = narrowest(F.col("_items"))
    kind = narrowest(F.col("_types"))
    whole = F.when((kind == "REPEATED") & item.isNull(), F.lit(None)).otherwise(kind)
    return found.select(
        "table_name", "name", whole.alias("type"), F.when(kind == "REPEATED", item).alias("item_type"), "versions", "nullable"
    )


def change_order() -> list[Column]:
    """Sort keys that list a table's changes in source order, removed columns last."""
    return [F.col("table_name"), F.col("change_type") == REMOVE_COLUMN, F.col("ordinal")]


def halted_tables(changes: DataFrame) -> DataFrame:
    """Tables with any incompatible change."""
    return (
        changes.groupBy("table_name")
        .agg(F.bool_or(F.col("change_type") == TYPE_INCOMPATIBLE).alias("halted"))
        .where("halted")
        .select("table_name")
    )


def halt_incompatible(plan: DataFrame, changes: DataFrame, name: str = "name") -> DataFrame:
    """The part of a sync plan that may run: tables without an incompatible change."""
    halted = halted_tables(changes).withColumnRenamed("table_name", name)
    return plan.join(halted, name, "left_anti")


def apply_changes(dest: T.StructType, source: T.StructType, changes: Iterable[Mapping]) -> T.StructType:
    """The destination schema after all compatible changes of one table.

    Added columns go last and are nullable, removed ones stay, widened ones take the source's type.
    Works on one table's metadata only.
    """
    changed = {c["name"]: c["change_type"] for c in changes}
    bad = sorted(n for n, kind in changed.items() if kind == TYPE_INCOMPATIBLE)
    if bad:
        raise IncompatibleSchema(f"incompatible schema change on column {', '.join(bad)}")
    incoming = {f.name: f for f in source.fields}
    fields = []
    for old in dest.fields:
        new = incoming.get(old.name)
        if changed.get(old.name) == TYPE_WIDEN and isinstance(new.dataType, T.DecimalType):
            fields.append(T.StructField(old.name, _decimal_for(old, new.dataType), True, old.metadata))
        elif changed.get(old.name) == TYPE_WIDEN:
            fields.append(stored_field(new))
        elif new is not None and isinstance(old.dataType, T.DecimalType):
            fields.append(T.StructField(old.name, _common_decimal(old, new), True, old.metadata))
        else:
            fields.append(T.StructField(old.name, old.dataType, True, old.metadata))
    fields += [stored_field(f) for f in source.fields if changed.get(f.name) == ADD_COLUMN]
    names = [f.name.lower() for f in fields]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise IncompatibleSchema(f"incompatible schema change: columns differ in case only: {', '.join(twice)}")
    return T.StructType(fields)


def _decimal_for(old: T.StructField, new: T.DecimalType) -> T.DecimalType:
    # What is stored must stay readable: a bigint may have 19 digits, floating point is kept to nine decimals at least.
    whole = isinstance(old.dataType, T.IntegralType)
    scale = new.scale if whole else max(new.scale, T.DecimalType(38, 9).scale)
    digits = max(19 if whole else 38 - scale, new.precision - new.scale) + scale
    if digits > T.DecimalType(38, 9).precision:
        raise IncompatibleSchema(f"incompatible type of column {old.name}: no decimal holds both {old.dataType.simpleString()} and {new.simpleString()}")
    return T.DecimalType(digits, scale)


def _common_decimal(old: T.StructField, new: T.StructField) -> T.DataType:
    # Two NUMERIC columns are the same canonical type, yet the destination must hold every digit of both.
    a, b = old.dataType, new.dataType
    if not isinstance(b, T.DecimalType):
        return a
    scale = max(a.scale, b.scale)
    digits = max(a.precision - a.scale, b.precision - b.scale) + scale
    if digits > T.DecimalType(38, 9).precision:
        raise IncompatibleSchema(f"incompatible type of column {old.name}: no decimal holds both {a} and {b}")
    return T.DecimalType(digits, scale)


def local_changes(dest: T.StructType, source: T.StructType) -> list[dict]:
    """The changes of one table by name and kind, from two schemas at hand, for streams and single loads."""
    return [{k: c[k] for k in ("name", "change_type")} for c in changed_columns(dest, source)]


def changed_columns(dest: T.StructType, source: T.StructType, strict_items: bool = False) -> list[dict]:
    """The rows of ``schema_diff`` for one table, from two schemas at hand."""
    old = {f.name: (*canonical(f), i) for i, f in enumerate(dest.fields, 1)}
    new = {f.name: (*canonical(f), i) for i, f in enumerate(source.fields, 1)}
    changes = []
    for name in [*new, *(n for n in old if n not in new)]:
        (was, was_item, at), (now, item, to) = old.get(name, (None,) * 3), new.get(name, (None,) * 3)
        if was is None:
            change = ADD_COLUMN
        elif now is None:
            change = REMOVE_COLUMN
        elif was != now:
            change = TYPE_WIDEN if widens(was, now) else TYPE_INCOMPATIBLE
        elif strict_items and was_item != item:
            change = TYPE_INCOMPATIBLE
        else:
            continue
        changes.append({
            "name": name, "change_type": change, "old_type": was, "old_item_type": was_item,
            "new_type": now, "new_item_type": item, "ordinal": to or at,
        })
    return changes


def _items_shrink(source: T.DataType, target: T.DataType) -> bool:
    """Whether a cast between two array types could lose part of an item."""
    if not (isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType)) or source.elementType == target.elementType:
        return False
    old, new = (canonical(T.StructField("item", t.elementType))[0] for t in (source, target))
    return old != new and not widens(old, new)


def _aligned(source: T.StructField, target: T.StructField) -> Column:
    column = F.col(f"`{source.name}`")
    old, new = canonical(source)[0], canonical(target)[0]
    complex_text = old in ("STRING", "JSON") and isinstance(
        source.dataType, (T.StructType, T.MapType, T.ArrayType, T.VariantType)
    )
    if complex_text and isinstance(target.dataType, T.StringType):
        column = F.to_json(column)
    elif old != new and not widens(old, new):
        raise IncompatibleSchema(f"incompatible type of column {source.name}: {old} cannot become {new}")
    elif _items_shrink(source.dataType, target.dataType):
        raise IncompatibleSchema(f"incompatible item type of column {source.name}: {source.dataType.simpleString()} cannot become {target.dataType.simpleString()}")
    elif source.dataType != target.dataType:
        column = column.cast(target.dataType)
    return column.alias(target.name, metadata=target.metadata or {})


def align_batch(batch: DataFrame, target: T.StructType) -> DataFrame:
    """A batch in the destination's column order and types; columns it lacks are NULL."""
    have = {f.name: f for f in batch.schema.fields}
    extra = [n for n in have if n not in target.names]
    if extra:
        raise IncompatibleSchema(f"incompatible schema: the destination has no column {', '.join(extra)}")
    return batch.select([
        _aligned(have[f.name], f) if f.name in have
        else F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata or {})
        for f in target.fields
    ])


def schema_preview(plan: DataFrame, source: DataFrame) -> DataFrame:
    """What a sync would see, without moving data: every planned table's columns and one line for each."""
    columns = source.withColumnRenamed("name", "column_name").withColumnRenamed("table_name", "name")
    # The line's layout.
    line = F.concat(
        F.format_string("- %-20s %s", F.col("column_name"), F.col("type")),
        F.when(F.col("item_type").isNotNull(), F.concat(F.lit(" [items: "), "item_type", F.lit("]"))).otherwise(""),
        F.when(F.col("nullable"), " (nullable)").otherwise(""),
    )
    return plan.join(columns, "name").select(
        "name", dest_name().alias("destination"), "sync_mode", "cursor_field", "ordinal", "column_name",
        "type", "item_type", "nullable", line.alias("line"),
    )


def dest_name() -> Column:
    """A plan row's destination: its override, or the source name."""
    return F.coalesce(F.nullif(F.col("destination_table"), F.lit("")), F.col("name"))
