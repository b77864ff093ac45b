"""Schema drift. Customers stand for tables and their orders for columns, on both sides of a sync."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import expected
from checks.registry import pick, pick_sql, read, register
from tidelane.functions import typemap
from tidelane.operators import monitor, schema
from tidelane.types import CANONICAL_TYPES

TYPES = list(CANONICAL_TYPES)
_SAFE = expected.WIDENINGS


def _side(spark, sf_dir, number, kept):
    orders = read(spark, sf_dir, "orders").withColumn("_number", F.expr(number)).where(kept)
    return orders.select(
        F.concat(F.lit("t"), F.col("o_custkey").cast("string")).alias("table_name"),
        F.col("o_orderkey").cast("int").alias("ordinal"),
        F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("name"),
        pick(TYPES, "_number").alias("type"),
        F.when(pick(TYPES, "_number") == "REPEATED", pick(TYPES[:9], "o_orderkey")).alias("item_type"),
        (F.col("o_orderstatus") != "F").alias("nullable"),
    )


def _side_sql(number, kept):
    return f"""
        SELECT 't' || CAST(o_custkey AS VARCHAR) AS table_name, CAST(o_orderkey AS INTEGER) AS ordinal,
               'c' || CAST(o_orderkey AS VARCHAR) AS name, {pick_sql(TYPES, number)} AS type,
               CASE WHEN {pick_sql(TYPES, number)} = 'REPEATED' THEN {pick_sql(TYPES[:9], 'o_orderkey')} END AS item_type,
               o_orderstatus <> 'F' AS nullable
        FROM orders WHERE {kept}
    """


_VERSIONS = """
    concat('t', CAST(o_custkey AS STRING)) AS table_name, concat('c', CAST(o_orderkey % 2 AS STRING)) AS name,
    o_orderkey * 7 + o_custkey AS number, o_orderkey AS version, o_orderstatus <> 'F' AS nullable
"""
_RANKED = ", ".join(f"({i}, '{t}')" for i, t in enumerate(typemap.TYPE_ORDER))


@register(f"""
    WITH o AS (SELECT {_VERSIONS.replace('AS STRING', 'AS VARCHAR')} FROM orders),
    v AS (SELECT table_name, name, nullable, {pick_sql(TYPES, 'number')} AS type,
          CASE WHEN {pick_sql(TYPES, 'number')} = 'REPEATED' THEN {pick_sql(TYPES[:9], 'version')} END AS item FROM o),
    k AS (SELECT table_name, name, count(*) AS versions, bool_or(nullable) AS nullable, count(item) AS n_items FROM v GROUP BY 1, 2),
    c(rank, kind) AS (VALUES {_RANKED}),
    t AS (SELECT table_name, name, arg_min(kind, rank) AS type FROM (
            SELECT v.table_name, v.name, kind, rank FROM v JOIN c ON v.type = kind OR (v.type, kind) IN ({_SAFE})
            GROUP BY 1, 2, 3, 4 HAVING count(*) = (SELECT versions FROM k WHERE k.table_name = v.table_name AND k.name = v.name)) GROUP BY 1, 2),
    i AS (SELECT table_name, name, arg_min(kind, rank) AS item_type FROM (
            SELECT v.table_name, v.name, kind, rank FROM v JOIN c ON v.item = kind OR (v.item, kind) IN ({_SAFE})
            GROUP BY 1, 2, 3, 4 HAVING count(*) = (SELECT n_items FROM k WHERE k.table_name = v.table_name AND k.name = v.name)) GROUP BY 1, 2)
    SELECT k.table_name, k.name, CASE WHEN t.type = 'REPEATED' AND item_type IS NULL THEN NULL ELSE t.type END AS type,
           CASE WHEN t.type = 'REPEATED' THEN item_type END AS item_type, versions, nullable
    FROM k LEFT JOIN t ON k.table_name = t.table_name AND k.name = t.name LEFT JOIN i ON k.table_name = i.table_name AND k.name = i.name
""")
def common_types(spark, sf_dir):
    """Columns that changed their type over many versions, each brought to one type or found to have none."""
    rows = spark.sql(f"SELECT {_VERSIONS} FROM {{orders}}", orders=read(spark, sf_dir, "orders"))
    kind = pick(TYPES, "number")
    typed = rows.withColumn("type", kind).withColumn("item_type", F.when(kind == "REPEATED", pick(TYPES[:9], "version")))
    return schema.common_types(typed)


# Urgent orders are columns only the source has, low ones only the destination; about half keep their type.
_SOURCE_KEPT = "o_orderpriority <> '5-LOW'"
_DEST_KEPT = "o_orderpriority <> '1-URGENT' AND o_totalprice > 20000"
_SOURCE_TYPE = "CASE WHEN o_orderstatus = 'O' THEN o_orderkey ELSE o_custkey END"
_DEST_TYPE = "o_custkey"

_DIFF_SQL = f"""
    src AS ({_side_sql(f'({_SOURCE_TYPE})', _SOURCE_KEPT)}),
    dst AS ({_side_sql(_DEST_TYPE, _DEST_KEPT)}),
    diff AS (
        SELECT * FROM (
            SELECT coalesce(s.table_name, d.table_name) AS table_name, coalesce(s.name, d.name) AS name,
                   CASE WHEN d.name IS NULL THEN 'add_column' WHEN s.name IS NULL THEN 'remove_column'
                        WHEN s.type = d.type THEN NULL
                        WHEN (d.type, s.type) IN ({_SAFE}) THEN 'type_widen'
                        ELSE 'type_incompatible' END AS change_type,
                   d.type AS old_type, d.item_type AS old_item_type, s.type AS new_type, s.item_type AS new_item_type,
                   coalesce(s.ordinal, d.ordinal) AS ordinal
            FROM (SELECT * FROM src WHERE table_name IN (SELECT table_name FROM dst)) s
            FULL OUTER JOIN dst d ON s.table_name = d.table_name AND s.name = d.name
        ) WHERE change_type IS NOT NULL
    )
"""


def _changes(spark, sf_dir):
    source = _side(spark, sf_dir, _SOURCE_TYPE, _SOURCE_KEPT)
    return schema.schema_diff(source, _side(spark, sf_dir, _DEST_TYPE, _DEST_KEPT))


@register(f"WITH {_DIFF_SQL} SELECT * FROM diff")
def schema_diff(spark, sf_dir):
    return _changes(spark, sf_dir)


@register(f"""
    SELECT old_type, new_type, (old_type, new_type) IN ({_SAFE}) AS widening, CAST(count(*) AS BIGINT) AS pairs
    FROM (SELECT {pick_sql(TYPES, 'l_partkey')} AS old_type, {pick_sql(TYPES, 'l_suppkey')} AS new_type FROM lineitem)
    GROUP BY old_type, new_type
""")
def is_widening(spark, sf_dir):
    pairs = read(spark, sf_dir, "lineitem").select(
        pick(TYPES, "l_partkey").alias("old_type"), pick(TYPES, "l_suppkey").alias("new_type")
    )
    counted = pairs.groupBy("old_type", "new_type").agg(F.count(F.lit(1)).alias("pairs"))
    return counted.withColumn("widening", typemap.is_widening(F.col("old_type"), F.col("new_type")))


_PLAN = """
    concat('t', CAST(c_custkey AS STRING)) AS name,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'full_refresh' WHEN c_mktsegment = 'MACHINERY' THEN 'append_only'
         ELSE 'incremental' END AS sync_mode,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN 'updated_at' END AS cursor_field,
    CASE WHEN c_nationkey < 5 THEN '' WHEN c_nationkey < 15 THEN concat('dim_', c_name) END AS destination_table,
    CASE WHEN c_nationkey < 12 THEN 0 ELSE c_nationkey END AS timeout_minutes
"""
PLAN_SQL = f"SELECT {_PLAN.replace('AS STRING', 'AS VARCHAR')} FROM customer"


def plan(spark, sf_dir):
    return spark.sql(f"SELECT {_PLAN} FROM {{customer}}", customer=read(spark, sf_dir, "customer"))


@register(f"""
    WITH {_DIFF_SQL}
    SELECT * FROM ({PLAN_SQL})
    WHERE name NOT IN (SELECT table_name FROM diff WHERE change_type = 'type_incompatible')
""")
def halt_incompatible(spark, sf_dir):
    return schema.halt_incompatible(plan(spark, sf_dir), _changes(spark, sf_dir))


@register(f"SELECT name, coalesce(nullif(destination_table, ''), name) AS destination FROM ({PLAN_SQL})")
def dest_name(spark, sf_dir):
    return plan(spark, sf_dir).select("name", schema.dest_name().alias("destination"))


@register(f"""
    WITH s AS ({_side_sql('o_custkey', 'true')})
    SELECT p.name, coalesce(nullif(destination_table, ''), p.name) AS destination, sync_mode, cursor_field, ordinal,
           s.name AS column_name, type, item_type, nullable,
           '- ' || rpad(s.name, CAST(greatest(20, length(s.name)) AS INTEGER), ' ') || ' ' || type
               || coalesce(' [items: ' || item_type || ']', '')
               || CASE WHEN nullable THEN ' (nullable)' ELSE '' END AS line
    FROM ({PLAN_SQL}) p JOIN s ON p.name = s.table_name
""")
def schema_preview(spark, sf_dir):
    return schema.schema_preview(plan(spark, sf_dir), _side(spark, sf_dir, "o_custkey", "true"))


@register(f"""
    WITH {_DIFF_SQL}
    SELECT table_name, name, CASE change_type
        WHEN 'add_column' THEN '  + Added column: ' || name || ' (' || new_type || ')'
        WHEN 'remove_column' THEN '  - Removed column: ' || name || ' (was ' || old_type || ')'
        WHEN 'type_widen' THEN '  ↑ Type widened: ' || name || ' (' || old_type || ' → ' || new_type || ')'
        ELSE '  ⛔ Incompatible type change: ' || name || ' (' || old_type || ' → ' || new_type || ')' END AS line
    FROM diff
    UNION ALL
    SELECT DISTINCT table_name, NULL, '⛔ INCOMPATIBLE CHANGES DETECTED — sync halted for this table'
    FROM diff WHERE change_type = 'type_incompatible'
""")
def schema_change_report(spark, sf_dir):
    return monitor.schema_change_report(_changes(spark, sf_dir))


@register(f"""
    SELECT name, sync_mode, cursor_field, destination_table, timeout_minutes FROM ({PLAN_SQL})
    WHERE name NOT IN (SELECT 't' || CAST(o_custkey AS VARCHAR) FROM orders WHERE o_totalprice > 450000)
""")
def missing_tables(spark, sf_dir):
    have = read(spark, sf_dir, "orders").where("o_totalprice > 450000").select(
        F.concat(F.lit("t"), F.col("o_custkey").cast("string")).alias("table_name")
    )
    return monitor.missing_tables(plan(spark, sf_dir), have)


# Plans with every kind of mistake: the segment breaks the mode, the nation breaks the name or the cursor.
_DRAFT = """
    CAST(c_custkey AS BIGINT) AS position,
    CASE WHEN c_nationkey = 3 THEN '' WHEN c_nationkey = 4 THEN NULL ELSE c_name END AS name,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'full_refresh' WHEN 'MACHINERY' THEN 'append_only'
         WHEN 'HOUSEHOLD' THEN 'merge' WHEN 'FURNITURE' THEN '' ELSE 'incremental' END AS sync_mode,
    CASE WHEN c_nationkey < 8 THEN '' WHEN c_nationkey < 16 THEN 'id' END AS cursor_field
"""


@register(f"""
    WITH p AS (SELECT {_DRAFT} FROM customer), v AS (
        SELECT position, 1 AS rule, 'sync.tables[' || position || '].name is required' AS violation
        FROM p WHERE coalesce(name, '') = ''
        UNION ALL SELECT position, 2, 'sync.tables[' || position || '].sync_mode is required'
        FROM p WHERE coalesce(sync_mode, '') = ''
        UNION ALL SELECT position, 3, 'sync.tables[' || position || '].sync_mode "' || sync_mode
            || '" is invalid (valid: incremental, full_refresh, append_only)'
        FROM p WHERE coalesce(sync_mode, '') NOT IN ('', 'incremental', 'full_refresh', 'append_only')
        UNION ALL SELECT position, 4, 'sync.tables[' || position || '] (' || coalesce(name, '')
            || '): cursor_field is required for ' || sync_mode || ' mode'
        FROM p WHERE sync_mode IN ('incremental', 'append_only') AND coalesce(cursor_field, '') = ''
    )
    SELECT position, CAST(row_number() OVER (PARTITION BY position ORDER BY rule) AS INTEGER) AS rule_no, violation FROM v
""")
def validate_plan(spark, sf_dir):
    draft = spark.sql(f"SELECT {_DRAFT} FROM {{customer}}", customer=read(spark, sf_dir, "customer"))
    return monitor.validate_plan(draft)
