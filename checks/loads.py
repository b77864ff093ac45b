"""Loads into destination tables, read back from there."""

from __future__ import annotations

import datetime as dt
import itertools
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import read, register
from tidelane.frames import small_frame
from tidelane.functions.text import format_bytes
from tidelane.operators import dedup, jsonl, schema
from tidelane.operators import ledger as L
from tidelane.operators.monitor import mask_columns
from tidelane.operators.table import SyncTable
from tidelane.plans import modes
from tidelane.plans.sync import TablePlan, results_frame, sync_tables as sync, with_retry
from tidelane.session import new_folder
from tidelane.sources.connectors import FileSource
from tidelane.types import canonical

_START = dt.datetime(2024, 2, 1)


def _table(spark, name):
    return SyncTable(spark, new_folder(spark, "loads"), name)


def _counting_clock():
    """A clock that moves one second per call, for repeatable ledgers."""
    ticks = itertools.count()
    return lambda: _START + dt.timedelta(seconds=next(ticks))


class _Snapshot:
    """A source as it stood at some moment: its tables with rows filtered by an expression."""

    def __init__(self, source, where):
        self.source, self.where = source, where

    def table_names(self):
        return self.source.table_names()

    def read(self, name):
        rows = self.source.read(name)
        return rows.where(self.where[name]) if name in self.where else rows


def _two_runs(spark, sf_dir, plan, first):
    """Sync a table twice, first from an earlier snapshot, and give the destination."""
    root, source, clock = new_folder(spark, "loads"), FileSource(spark, sf_dir), _counting_clock()
    for number, snapshot in enumerate((_Snapshot(source, {plan.name: first}), source)):
        (result,) = sync(
            spark, [plan], snapshot, f"{root}/tables", f"{root}/ledger", "check", run_id=f"r{number}", clock=clock
        )
        if not result.success:
            raise RuntimeError(result.error)
    return SyncTable(spark, f"{root}/tables", plan.destination).read()


_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


@register(_EVENTS)
def incremental_load(spark, sf_dir):
    return _two_runs(spark, sf_dir, TablePlan("events", "incremental", "ts"), "ts <= '2024-01-16'")


@register("""
    SELECT CAST(ts AS DATE) AS day, event_type, CAST(count(*) AS BIGINT) AS n,
           CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS total
    FROM events GROUP BY 1, 2
""")
def incremental_daily(spark, sf_dir):
    loaded = _two_runs(spark, sf_dir, TablePlan("events", "incremental", "ts"), "ts <= '2024-01-16'")
    return loaded.groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total")
    )


@register("""
    SELECT event_id, count(*) AS times FROM (
        SELECT event_id FROM events
        UNION ALL SELECT event_id FROM events WHERE ts <= '2024-01-16'
            AND ts > (SELECT max(ts) FROM events WHERE ts <= '2024-01-22') - INTERVAL 10 DAY)
    GROUP BY 1
""")
def lookback_after_purge(spark, sf_dir):
    """A source that lost its newest rows is read back; the cursor stays, and the next load adds without replacing."""
    root, source, clock = new_folder(spark, "loads"), FileSource(spark, sf_dir), _counting_clock()
    for number, (days, seen) in enumerate(((None, "ts <= '2024-01-22'"), (10, "ts <= '2024-01-16'"), (None, "true"))):
        plan = TablePlan("events", "incremental", "ts", lookback=days and dt.timedelta(days=days))
        (result,) = sync(
            spark, [plan], _Snapshot(source, {"events": seen}), f"{root}/tables", f"{root}/ledger", "check", run_id=f"r{number}", clock=clock
        )
        if not result.success:
            raise RuntimeError(result.error)
    loaded = SyncTable(spark, f"{root}/tables", "events").read()
    return loaded.groupBy("event_id").agg(F.count(F.lit(1)).alias("times"))


@register(_EVENTS)
def two_feeds_after_refresh(spark, sf_dir):
    """Two connections fill one table. One begins with a full copy, which says nothing about where the other stands."""
    root, source, clock = new_folder(spark, "loads"), FileSource(spark, sf_dir), _counting_clock()
    runs = (
        ("a", "full_refresh", "user_id % 2 = 0 AND ts <= '2024-01-20'"), ("a", "incremental", "user_id % 2 = 0"),
        ("b", "incremental", "user_id % 2 = 1 AND ts <= '2024-01-10'"), ("b", "incremental", "user_id % 2 = 1"),
        ("a", "incremental", "user_id % 2 = 0"),
    )
    for number, (connection, mode, seen) in enumerate(runs):
        (result,) = sync(
            spark, [TablePlan("events", mode, "ts")], _Snapshot(source, {"events": seen}), f"{root}/tables", f"{root}/ledger", connection,
            run_id=f"r{number}", clock=clock,
        )
        if not result.success:
            raise RuntimeError(result.error)
    return SyncTable(spark, f"{root}/tables", "events").read()


@register("SELECT * FROM orders")
def keyset_load(spark, sf_dir):
    """Rows that were committed late with the cursor value a load ended at are loaded once, with the next load."""
    root, source, clock = new_folder(spark, "loads"), FileSource(spark, sf_dir), _counting_clock()
    plan = TablePlan("orders", "incremental", "o_orderdate", tie_keys=("o_orderkey",))
    day = "o_orderdate < '1995-06-17' OR o_orderdate = '1995-06-17'"
    for number, seen in enumerate((f"{day} AND o_orderkey % 3 = 0", f"{day} AND o_orderkey % 3 < 2", day, "true", "true")):
        (result,) = sync(
            spark, [plan], _Snapshot(source, {"orders": seen}), f"{root}/tables", f"{root}/ledger", "check", run_id=f"r{number}", clock=clock
        )
        if not result.success:
            raise RuntimeError(result.error)
    return SyncTable(spark, f"{root}/tables", "orders").read()


@register("SELECT * FROM conversations")
def append_only_load(spark, sf_dir):
    plan = TablePlan("conversations", "append_only", "conv_id", destination_table="talks")
    return _two_runs(spark, sf_dir, plan, "conv_id <= 50")


@register("""
    SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part
""")
def full_refresh(spark, sf_dir):
    part, table = read(spark, sf_dir, "part"), _table(spark, "part")
    modes.full_refresh(part.where("p_size > 10"), table)
    modes.full_refresh(part, table, records_per_file=10_000)
    return table.read()


@register("""
    SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
           l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
    FROM lineitem
""")
def append_batch(spark, sf_dir):
    lines, table = read(spark, sf_dir, "lineitem"), _table(spark, "lineitem")
    table.create(lines.schema)
    table.append(lines.where("l_linestatus = 'O'"), "l_open")
    table.append(lines.where("l_linestatus = 'F'"), "l_filled")
    table.append(lines.where("l_linestatus = 'F'"), "l_filled")  # a retry replaces its own rows
    table.append(lines.where("l_linestatus = 'none'"), "l_empty")
    return table.read()


@register("""
    SELECT 'l_open' AS load, CAST(count(*) AS BIGINT) AS rows, max(l_shipdate) AS cursor FROM lineitem
    WHERE l_linestatus = 'O'
    UNION ALL SELECT 'l_filled', CAST(count(*) AS BIGINT), max(l_shipdate) FROM lineitem WHERE l_linestatus = 'F'
    UNION ALL SELECT 'l_empty', 0, NULL
""")
def write_result(spark, sf_dir):
    """The counts a write reports are taken while it writes, in the same pass."""
    lines, table = read(spark, sf_dir, "lineitem"), _table(spark, "lineitem")
    table.create(lines.schema)
    results = []
    for load, status in (("l_open", "O"), ("l_filled", "F"), ("l_empty", "none")):
        done = table.append(lines.where(F.col("l_linestatus") == status), load, "l_shipdate")
        results.append({"load": load, "rows": done.rows, "cursor": done.max_cursor and done.max_cursor.value})
    columns = T.StructType().add("load", "string").add("rows", "long").add("cursor", "string")
    return small_frame(spark, results, columns).withColumn("cursor", F.col("cursor").cast("timestamp_ntz"))


@register("SELECT doc_id, text, lang, source, CASE WHEN n_chars > 500 THEN n_chars END AS n_chars FROM documents")
def append_jsonl(spark, sf_dir):
    path = new_folder(spark, "jsonl")
    documents = read(spark, sf_dir, "documents").withColumn("n_chars", F.expr("CASE WHEN n_chars > 500 THEN n_chars END"))
    for lang_is_english in (True, False):
        part = documents.where((F.col("lang") == "en") == lang_is_english)
        jsonl.append_jsonl(part, path, f"l_{lang_is_english}")
    return jsonl.read_jsonl(spark, path, documents.schema).select(*documents.columns)


def _line_bytes_sql(table, *columns):
    fields = ", ".join(f"{c} := {c}" for c in sorted(columns))
    return f"""
        SELECT '{table}' AS table_name, CAST(count(*) AS BIGINT) AS rows,
               CAST(sum(octet_length(encode(CAST(to_json(struct_pack({fields})) AS VARCHAR))) + 1) AS BIGINT) AS bytes
        FROM {table}
    """


_SUMMARY = {
    "nation": ("n_nationkey", "n_name", "n_regionkey"), "labels": ("doc_id", "quality", "toxic"),
    "conversations": ("conv_id", "turn", "role", "text"), "documents": ("doc_id", "text", "lang", "source", "n_chars"),
}


@register(f"""
    SELECT table_name, rows, bytes,
           CASE WHEN bytes >= 1048576 THEN printf('%.1f MB', bytes / 1048576.0)
                WHEN bytes >= 1024 THEN printf('%.1f KB', bytes / 1024.0) ELSE bytes || ' B' END AS size
    FROM ({' UNION ALL '.join(_line_bytes_sql(t, *c) for t, c in _SUMMARY.items())})
""")
def table_summary(spark, sf_dir):
    root = new_folder(spark, "jsonl")
    for table in _SUMMARY:
        jsonl.append_jsonl(read(spark, sf_dir, table), f"{root}/{table}", "l_all")
    return jsonl.table_summary(spark, root)


@register("""
    SELECT o_orderkey, CASE WHEN bytes >= 1048576 THEN printf('%.1f MB', bytes / 1048576.0)
           WHEN bytes >= 1024 THEN printf('%.1f KB', bytes / 1024.0) ELSE bytes || ' B' END AS size
    FROM (SELECT o_orderkey, o_orderkey * o_orderkey * o_custkey AS bytes FROM orders)
""")
def readable_size(spark, sf_dir):
    key, customer = F.col("o_orderkey").cast("decimal(38,0)"), F.col("o_custkey").cast("decimal(38,0)")
    size = key * key * customer  # beyond bigint for keys of some millions
    return read(spark, sf_dir, "orders").select("o_orderkey", format_bytes(size).alias("size"))


@register("SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier")
def create_table(spark, sf_dir):
    suppliers, table = read(spark, sf_dir, "supplier"), _table(spark, "supplier")
    table.create(suppliers.schema)
    table.create(suppliers.drop("s_name").schema)  # there already: left as it is
    table.append(suppliers, "l_all")
    return table.read()


def _column_sql(number, name, kind):
    return f"SELECT {number} AS ordinal, '{name}' AS name, '{kind}' AS type, count({name}) AS filled FROM part"


@register(f"""
    SELECT CAST(ordinal AS INTEGER) AS ordinal, name, type, CAST(filled AS BIGINT) AS filled FROM (
        {' UNION ALL '.join(_column_sql(i, n, t) for i, (n, t) in enumerate([
            ('p_partkey', 'INT64'), ('p_name', 'STRING'), ('p_brand', 'STRING'), ('p_type', 'STRING'),
            ('p_size', 'INT64'), ('p_retailprice', 'FLOAT64')], 1))}
    )
""")
def dest_schema(spark, sf_dir):
    """Columns the destination reports, each with its number of filled rows there."""
    part, table = read(spark, sf_dir, "part"), _table(spark, "part")
    modes.full_refresh(part, table)
    fields = table.refresh().schema().fields
    counts = table.read().agg(*(F.count(f.name).alias(f.name) for f in fields))
    columns = F.array(*(
        F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("name"), F.lit(canonical(f)[0]).alias("type"),
                 F.col(f.name).alias("filled"))
        for i, f in enumerate(fields, 1)
    ))
    return counts.select(F.inline(columns))


def _evolve(table, rows, load):
    changes = schema.local_changes(table.schema(), rows.schema)
    table.evolve(schema.apply_changes(table.schema(), rows.schema, changes))
    table.append(rows, load)


@register("""
    SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal,
           CASE WHEN c_nationkey >= 10 THEN c_mktsegment END AS c_mktsegment
    FROM customer
""")
def add_column(spark, sf_dir):
    customers, table = read(spark, sf_dir, "customer"), _table(spark, "customer")
    narrow = customers.drop("c_mktsegment")
    table.create(narrow.schema)
    table.append(narrow.where("c_nationkey < 10"), "l_1")
    _evolve(table, customers.where("c_nationkey >= 10"), "l_2")
    return table.read()


@register("""
    SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal,
           CASE WHEN c_nationkey < 10 THEN c_mktsegment END AS c_mktsegment
    FROM customer
""")
def removed_column(spark, sf_dir):
    customers, table = read(spark, sf_dir, "customer"), _table(spark, "customer")
    table.create(customers.schema)
    table.append(customers.where("c_nationkey < 10"), "l_1")
    _evolve(table, customers.drop("c_mktsegment").where("c_nationkey >= 10"), "l_2")
    return table.read()


_WIDENED = """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority,
           CAST(o_totalprice AS DECIMAL(38, 9)) AS o_totalprice, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS o_orderdate
    FROM orders
"""


def _widened_orders(spark, sf_dir):
    orders, table = read(spark, sf_dir, "orders"), _table(spark, "orders")
    narrow = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    wide = orders.withColumns({
        "o_custkey": F.col("o_custkey").cast("string"), "o_totalprice": F.col("o_totalprice").cast("decimal(38,9)"),
    })
    table.create(narrow.schema)
    table.append(narrow.where("o_orderstatus = 'F'"), "l_1")
    _evolve(table, wide.where("o_orderstatus <> 'F'"), "l_2")
    return table


@register(_WIDENED)
def widen_column(spark, sf_dir):
    return _widened_orders(spark, sf_dir).read()


@register(_WIDENED)
def rewrite_table(spark, sf_dir):
    table = _widened_orders(spark, sf_dir)
    table.rewrite()
    table.expire_versions()
    return table.read()


@register("""
    SELECT CAST(o_orderkey AS DECIMAL(21, 2)) AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders
""")
def widen_to_decimal(spark, sf_dir):
    """A bigint column whose source becomes a decimal too narrow for what is stored."""
    orders, table = read(spark, sf_dir, "orders"), _table(spark, "orders")
    table.create(orders.schema)
    table.append(orders.where("o_orderstatus = 'F'"), "l_1")
    _evolve(table, orders.where("o_orderstatus <> 'F'").withColumn("o_orderkey", F.col("o_orderkey").cast("decimal(9,2)")), "l_2")
    return table.refresh().read()


@register("""
    SELECT 'vectors' AS table_name, count(*) AS rows, true AS refused FROM embeddings
""")
def array_item_drift(spark, sf_dir):
    """Items that would be cut to whole numbers are refused; the rows loaded before stay as they are."""
    vectors, table = read(spark, sf_dir, "embeddings"), _table(spark, "vectors")
    column = next(f.name for f in vectors.schema.fields if isinstance(f.dataType, T.ArrayType))
    whole = vectors.withColumn(column, F.transform(column, lambda x: F.floor(x).cast("bigint")))
    table.create(whole.schema)
    table.append(whole, "l_1")
    try:
        table.append(vectors, "l_2")
        refused = False
    except schema.IncompatibleSchema:
        refused = True
    return table.read().agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(table.name).alias("table_name"), "rows", F.lit(refused).alias("refused")
    )


@register("""
    SELECT s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
           CASE WHEN s_suppkey < 50 THEN 'old' || s_name END AS s_legacy,
           CASE WHEN s_suppkey >= 50 THEN s_acctbal END AS s_acctbal
    FROM supplier
""")
def apply_changes(spark, sf_dir):
    suppliers, table = read(spark, sf_dir, "supplier"), _table(spark, "supplier")
    old = suppliers.drop("s_acctbal").withColumn("s_legacy", F.concat(F.lit("old"), "s_name"))
    new = suppliers.withColumn("s_nationkey", F.col("s_nationkey").cast("string"))
    table.create(old.schema)
    table.append(old.where("s_suppkey < 50"), "l_1")
    _evolve(table, new.where("s_suppkey >= 50"), "l_2")
    return table.read()


@register("""
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS DECIMAL(38, 9)) AS o_custkey,
           CAST(NULL AS VARCHAR) AS note, CAST(o_custkey AS DOUBLE) AS weight,
           CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS filled,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
    FROM orders
""")
def align_batch(spark, sf_dir):
    batch = read(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("day"), "o_orderkey", "o_custkey", F.col("o_custkey").alias("weight"),
        (F.col("o_orderstatus") == "F").alias("filled"),
    )
    target = T.StructType([
        T.StructField("o_orderkey", T.StringType()), T.StructField("o_custkey", T.DecimalType(38, 9)),
        T.StructField("note", T.StringType()), T.StructField("weight", T.DoubleType()),
        T.StructField("filled", T.StringType()), T.StructField("day", T.StringType()),
    ])
    return schema.align_batch(batch, target)


@register("SELECT * FROM orders WHERE o_orderstatus = 'O'")
def truncate_table(spark, sf_dir):
    orders, table = read(spark, sf_dir, "orders"), _table(spark, "orders")
    table.create(orders.schema)
    table.append(orders.where("o_orderstatus <> 'O'"), "l_1")
    table.truncate()
    table.append(orders.where("o_orderstatus = 'O'"), "l_2")
    return table.read()


@register("""
    SELECT 'before' AS seen, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS total
    FROM customer WHERE c_nationkey < 10
    UNION ALL SELECT 'after', CAST(count(*) AS BIGINT), CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) FROM customer
""")
def swap_tables(spark, sf_dir):
    """A reader that started before the swap still sees the old rows, one that starts after it the new."""
    customers, table = read(spark, sf_dir, "customer"), _table(spark, "customer")
    modes.full_refresh(customers.where("c_nationkey < 10"), table)
    before = table.read()
    folder, columns, _ = table.stage(customers)
    table.swap(folder, columns)

    def total(rows, seen):
        return rows.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("total")
        ).withColumn("seen", F.lit(seen))

    return total(before, "before").unionAll(total(table.read(), "after"))


@register("""
    WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)
    SELECT o_orderpriority, CAST(b AS BIGINT) AS batch_no, CAST(least(100, n - (b - 1) * 100) AS BIGINT) AS batch_rows
    FROM c, unnest(generate_series(1, CAST(ceil(n / 100.0) AS BIGINT))) AS s(b)
""")
def batch_slices(spark, sf_dir):
    return modes.batch_slices(read(spark, sf_dir, "orders"), 100, ["o_orderpriority"])


_LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


@register(f"""
    SELECT l_returnflag, {', '.join(_LINE_ORDER)}, row_no, CAST(ceil(row_no / 500.0) AS BIGINT) AS batch_no FROM (
        SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {', '.join(_LINE_ORDER)}) AS row_no FROM lineitem)
""")
def numbered_batches(spark, sf_dir):
    """The batch of every row; a group of a third of all rows is numbered by many tasks."""
    lines = read(spark, sf_dir, "lineitem").select("l_returnflag", *_LINE_ORDER)
    return modes.numbered_batches(lines, 500, ["l_returnflag"], list(_LINE_ORDER))


@register("""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
    ) WHERE rn = 1
""")
def latest_rows(spark, sf_dir):
    return dedup.latest_rows(read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"])


@register("""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events
    ) WHERE rn = 1
""")
def latest_events(spark, sf_dir):
    return dedup.latest_rows(read(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", ["event_id"])


@register("SELECT c_custkey, '***' AS c_name, c_nationkey, '***' AS c_acctbal, c_mktsegment FROM customer")
def mask_column(spark, sf_dir):
    return mask_columns(read(spark, sf_dir, "customer"), "c_name", "c_acctbal")


_SYNCED = ("region", "nation", "supplier", "part", "customer", "orders", "lineitem")
_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _SYNCED)


@register(f"""
    SELECT table_name, 'started' AS event, CAST(NULL AS BIGINT) AS rows, CAST(NULL AS VARCHAR) AS error FROM ({_COUNTS})
    UNION ALL SELECT table_name, 'completed', CAST(n AS BIGINT), NULL FROM ({_COUNTS})
    UNION ALL SELECT 'events', 'failed', NULL, 'unknown sync mode: merge'
""")
def sync_tables(spark, sf_dir):
    """Several tables in one run, one of which cannot be synced; the ledger tells what became of each."""
    root = new_folder(spark, "loads")
    plan = [TablePlan(t, "full_refresh") for t in _SYNCED if t not in ("orders", "lineitem")]
    plan += [TablePlan("orders", "incremental", "o_orderdate"), TablePlan("lineitem", "append_only", "l_shipdate"),
             TablePlan("events", "merge")]
    sync(spark, plan, FileSource(spark, sf_dir), f"{root}/tables", f"{root}/ledger", "check", run_id="r0")
    return L.read_ledger(spark, f"{root}/ledger").select("table_name", "event", "rows", "error")


@register(f"""
    SELECT table_name, 'started' AS event, CAST(NULL AS BIGINT) AS rows, CAST(NULL AS VARCHAR) AS error FROM ({_COUNTS})
    UNION ALL SELECT table_name, CASE table_name WHEN 'lineitem' THEN 'failed' ELSE 'completed' END,
           CASE WHEN table_name <> 'lineitem' THEN CAST(n AS BIGINT) END,
           CASE table_name WHEN 'lineitem' THEN 'deadline exceeded after 0.006 s' END
    FROM ({_COUNTS})
""")
def table_timeout(spark, sf_dir):
    """One table has no time to load; the others are not held up by it."""
    root = new_folder(spark, "loads")
    plan = [TablePlan(t, "full_refresh", timeout_minutes=0.0001 if t == "lineitem" else 0) for t in _SYNCED]
    sync(spark, plan, FileSource(spark, sf_dir), f"{root}/tables", f"{root}/ledger", "check", run_id="r0")
    return L.read_ledger(spark, f"{root}/ledger").select("table_name", "event", "rows", "error")


@register("""
    SELECT 'nation' AS table_name, true AS success, CAST(count(*) AS BIGINT) AS rows FROM nation
    UNION ALL SELECT 'orders', true, CAST(count(*) AS BIGINT) FROM orders
    UNION ALL SELECT 'absent', false, 0
    UNION ALL SELECT 'stuck', false, 0
""")
def isolated_tables(spark, sf_dir):
    """A table that cannot be opened and one whose source never answers hold up no other."""
    root, source = new_folder(spark, "loads"), FileSource(spark, sf_dir)

    class Stuck:
        def read(self, name):
            if name == "stuck":
                time.sleep(60)
            return source.read(name)

    plan = [TablePlan("stuck", "full_refresh", timeout_minutes=0.02), TablePlan("absent", "full_refresh")]
    plan += [TablePlan("nation", "full_refresh"), TablePlan("orders", "incremental", "o_orderdate")]
    results = sync(spark, plan, Stuck(), f"{root}/tables", f"{root}/ledger", "check", run_id="r0")
    return results_frame(spark, "r0", results).select("table_name", "success", "rows")


@register(_EVENTS)
def retry_load(spark, sf_dir):
    """A load whose first attempt dies after it wrote: the second replaces what the first left."""
    events, table, attempts = read(spark, sf_dir, "events"), _table(spark, "events"), []
    table.create(events.schema)

    def attempt():
        attempts.append(1)
        rows = events.where("ts <= '2024-01-20'") if len(attempts) == 1 else events
        done = modes.incremental_load(rows, table, "ts")
        if len(attempts) == 1:
            raise ConnectionError("connection reset by peer")
        return done

    with_retry(attempt, wait=lambda seconds: None)
    return table.read()
