"""Scans, cursors and source catalogs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks import expected
from checks.registry import pick, pick_sql, read, register
from tidelane.functions import typemap
from tidelane.functions.typemap import ARRAY_OIDS, DESTINATION_TYPES, SCALAR_OIDS, TYPE_NAMES
from tidelane.operators.jsonl import append_jsonl
from tidelane.session import new_folder
from tidelane.sources import feed_source, scan
from tidelane.sources.connectors import FileSource, split_conditions
from tidelane.sources.describe import describe_schema as describe
from tidelane.sources.describe import list_tables as base_tables
from tidelane.types import CANONICAL_TYPES

HALF_WAY = dt.datetime(2024, 1, 16)
PAST_END = dt.datetime(2030, 1, 1)
OIDS = [*SCALAR_OIDS, *ARRAY_OIDS, 0, 600, 99_999]
NAMES = [*TYPE_NAMES, "hstore", "point", ""]
DESTINATIONS = [*DESTINATION_TYPES.values(), "GEOGRAPHY"]


@register("SELECT * FROM orders")
def full_scan(spark, sf_dir):
    return scan.full_scan(FileSource(spark, sf_dir).read("orders"))


@register("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-16 00:00:00'")
def incremental_scan(spark, sf_dir):
    return scan.incremental_scan(read(spark, sf_dir, "events"), "ts", HALF_WAY)


@register("SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts > TIMESTAMP '2024-01-16 00:00:00' AND user_id >= 10")
def feed_scan(spark, sf_dir):
    """JSON lines read back by a connector that is a data source: partitions by file, filters tested while reading."""
    events, path = read(spark, sf_dir, "events"), new_folder(spark, "feed")
    append_jsonl(events, path)
    feed_source.register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    feed = spark.read.format("tidelane_feed").schema(events.schema).option("path", path).option("pushdown", "true").load()
    return scan.incremental_scan(feed, "ts", HALF_WAY).where("user_id >= 10")


@register("""
    SELECT split, n, n <= 2 * avg(n) OVER () AS even FROM (
        SELECT 'l_shipdate' AS split, count(*) AS n FROM lineitem UNION ALL SELECT 'l_partkey', count(*) FROM lineitem)
""")
def split_scan(spark, sf_dir):
    """A table read by conditions that quantiles gave: each row by one of them, in ranges of even size."""
    lines = read(spark, sf_dir, "lineitem")
    out = []
    for column in ("l_shipdate", "l_partkey"):
        conditions = split_conditions(lines, column, 16)
        ranges = F.array(*(F.when(F.expr(c), F.lit(i)) for i, c in enumerate(conditions)))
        met = lines.select(F.array_compact(ranges).alias("ranges"))
        # A row that meets no condition, or two, is counted in none.
        counted = met.where(F.size("ranges") == 1).groupBy("ranges").agg(F.count(F.lit(1)).alias("n"))
        out.append(counted.agg(F.sum("n").alias("n"), (F.max("n") <= 2 * F.avg("n")).alias("even")).withColumn("split", F.lit(column)))
    return out[0].unionByName(out[1])


@register("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-14 12:00:00'")
def lookback_scan(spark, sf_dir):
    return scan.incremental_scan(read(spark, sf_dir, "events"), "ts", HALF_WAY, dt.timedelta(hours=36))


_NULLED = "CASE WHEN event_type <> 'error' THEN ts END"


@register(f"""
    WITH e AS (SELECT event_id, {_NULLED} AS cursor_ts FROM events)
    SELECT 'first' AS run, event_id, cursor_ts FROM e
    UNION ALL SELECT 'later', event_id, cursor_ts FROM e WHERE cursor_ts > TIMESTAMP '2024-01-16 00:00:00'
""")
def first_run_scan(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", F.expr(_NULLED).alias("cursor_ts"))

    def run(name, after):
        return scan.incremental_scan(events, "cursor_ts", after).withColumn("run", F.lit(name))

    return run("first", None).unionAll(run("later", HALF_WAY))


@register("SELECT max(ts) AS max_cursor FROM events")
def max_cursor(spark, sf_dir):
    return scan.max_cursor(read(spark, sf_dir, "events"), "ts")


@register(f"""
    SELECT 'no rows' AS load, coalesce(max(ts), TIMESTAMP '2030-01-01 00:00:00') AS max_cursor
    FROM events WHERE ts > TIMESTAMP '2030-01-01 00:00:00'
    UNION ALL SELECT 'no cursors', coalesce(max({_NULLED}), TIMESTAMP '2024-01-16 00:00:00')
    FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'rows', coalesce(max({_NULLED}), TIMESTAMP '2024-01-16 00:00:00') FROM events
""")
def keep_cursor_on_empty(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    nulled = events.withColumn("ts", F.expr(_NULLED))
    loads = [
        ("no rows", scan.incremental_scan(events, "ts", PAST_END), PAST_END),
        ("no cursors", nulled.where("event_type = 'error'"), HALF_WAY),
        ("rows", nulled, HALF_WAY),
    ]
    results = [scan.max_cursor(rows, "ts", old).withColumn("load", F.lit(name)) for name, rows, old in loads]
    return results[0].unionAll(results[1]).unionAll(results[2])


_CATALOG = """
    c_name AS table_name,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'audit' ELSE 'public' END AS table_schema,
    CASE WHEN c_nationkey < 5 THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type
"""


@register(f"""
    SELECT table_name FROM (SELECT {_CATALOG} FROM customer)
    WHERE table_schema = 'public' AND table_type = 'BASE TABLE'
""")
def list_tables(spark, sf_dir):
    return base_tables(read(spark, sf_dir, "customer").selectExpr(*_split(_CATALOG)))


def _split(columns: str) -> list[str]:
    return [c.strip() for c in columns.strip().split(",\n")]


def _mapped_sql(number: str) -> str:
    kind, item = expected.TYPE_OF_NUMBER.format(number), expected.ITEM_OF_NUMBER.format(number)
    return f"""
        coalesce(CASE {kind} END, CASE WHEN (CASE {item} END) IS NOT NULL THEN 'REPEATED' END, 'STRING') AS type,
        CASE {item} END AS item_type, coalesce(CASE {kind} END, CASE {item} END) IS NOT NULL AS known
    """


def _columns_sql(where: str) -> str:
    return f"""
        SELECT {_NAMESPACE} AS namespace, s_name AS table_name, l_linenumber - 2 AS ordinal,
               concat('c', CAST(l_orderkey AS VARCHAR)) AS name, l_partkey AS type_oid,
               NOT (l_tax > 0.04) AS nullable, {_mapped_sql('l_partkey')}
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
        WHERE l_linenumber > 2 AND l_returnflag <> 'R' AND {where}
    """


_NAMESPACE = "CASE WHEN n_regionkey < 3 THEN 'public' ELSE n_name END"


def _described(spark, sf_dir, schema):
    attributes = read(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS attrelid", "concat('c', CAST(l_orderkey AS STRING)) AS attname", "l_partkey AS atttypid",
        "l_linenumber - 2 AS attnum", "l_tax > 0.04 AS attnotnull", "l_returnflag = 'R' AS attisdropped",
    )
    classes = read(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS class_oid", "s_name AS relname", "s_nationkey AS relnamespace"
    )
    namespaces = read(spark, sf_dir, "nation").selectExpr("n_nationkey AS namespace_oid", f"{_NAMESPACE} AS nspname")
    types = read(spark, sf_dir, "part").selectExpr("p_partkey AS type_oid")
    return describe(attributes, classes, namespaces, types, schema)


@register(_columns_sql(f"{_NAMESPACE} = 'public'"))
def describe_schema(spark, sf_dir):
    return _described(spark, sf_dir, "public")


@register(_columns_sql("true"))
def describe_all_schemas(spark, sf_dir):
    return _described(spark, sf_dir, None)


@register(f"""
    SELECT o_orderkey, type_oid, {_mapped_sql('type_oid')}
    FROM (SELECT o_orderkey, CAST({pick_sql(OIDS, 'o_custkey')} AS BIGINT) AS type_oid FROM orders)
""")
def map_source_types(spark, sf_dir):
    return typemap.map_source_types(read(spark, sf_dir, "orders").select("o_orderkey", pick(OIDS, "o_custkey").alias("type_oid")))


_SUFFIX = "CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN '[]' ELSE '[][]' END"
_NAMED = expected.TYPE_OF_NAME.format("base")


@register(f"""
    WITH n AS (
        SELECT o_orderkey, base || {_SUFFIX} AS type_name, CASE {_NAMED} END AS base_type, o_orderstatus
        FROM (SELECT *, {pick_sql(NAMES, 'o_custkey')} AS base FROM orders)
    )
    SELECT o_orderkey, type_name,
           CASE WHEN base_type IS NULL THEN 'STRING' WHEN o_orderstatus = 'F' THEN base_type ELSE 'REPEATED' END AS type,
           CASE WHEN base_type IS NULL OR o_orderstatus = 'F' THEN NULL
                WHEN o_orderstatus = 'O' THEN base_type ELSE 'REPEATED' END AS item_type,
           base_type IS NOT NULL AS known
    FROM n
""")
def map_source_type_names(spark, sf_dir):
    named = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(pick(NAMES, "o_custkey"), F.expr(_SUFFIX)).alias("type_name")
    )
    return typemap.map_source_type_names(named)


_TO_DEST = expected.TO_DESTINATION.format("coalesce(item_type, type)")
_FROM_DEST = expected.FROM_DESTINATION.format("dest_type")


@register(f"""
    WITH s AS (
        SELECT o_orderkey, {pick_sql(list(CANONICAL_TYPES), 'o_custkey')} AS type,
               CASE WHEN {pick_sql(list(CANONICAL_TYPES), 'o_custkey')} = 'REPEATED'
                    THEN {pick_sql(list(CANONICAL_TYPES[:9]), 'o_orderkey')} END AS item_type,
               o_orderstatus <> 'F' AS nullable
        FROM orders
    )
    SELECT o_orderkey, type, item_type, nullable,
           coalesce(CASE {_TO_DEST} END, 'STRING') AS dest_type,
           CASE WHEN type = 'REPEATED' THEN 'REPEATED' WHEN nullable THEN 'NULLABLE' ELSE 'REQUIRED' END AS mode
    FROM s
""")
def dest_type_map(spark, sf_dir):
    kind = pick(list(CANONICAL_TYPES), "o_custkey")
    rows = read(spark, sf_dir, "orders").select(
        "o_orderkey", kind.alias("type"),
        F.when(kind == "REPEATED", pick(list(CANONICAL_TYPES[:9]), "o_orderkey")).alias("item_type"),
        (F.col("o_orderstatus") != "F").alias("nullable"),
    )
    return typemap.to_destination_columns(rows)


@register(f"""
    WITH d AS (
        SELECT o_orderkey, {pick_sql(DESTINATIONS, 'o_custkey')} AS dest_type,
               CASE o_orderstatus WHEN 'F' THEN 'NULLABLE' WHEN 'O' THEN 'REQUIRED' ELSE 'REPEATED' END AS mode
        FROM orders
    ), t AS (SELECT *, coalesce(CASE {_FROM_DEST} END, 'STRING') AS scalar FROM d)
    SELECT o_orderkey, dest_type, mode, CASE WHEN mode = 'REPEATED' THEN 'REPEATED' ELSE scalar END AS type,
           CASE WHEN mode = 'REPEATED' THEN scalar END AS item_type, mode <> 'REQUIRED' AS nullable
    FROM t
""")
def source_type_map(spark, sf_dir):
    columns = read(spark, sf_dir, "orders").select(
        "o_orderkey", pick(DESTINATIONS, "o_custkey").alias("dest_type"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'NULLABLE' WHEN 'O' THEN 'REQUIRED' ELSE 'REPEATED' END").alias("mode"),
    )
    return typemap.from_destination_columns(columns)
