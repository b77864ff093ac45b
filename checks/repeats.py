"""Loads that run again after a crash, a repair, a rewrite or a change of mode: each row arrives once."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import read, register
from tidelane.operators import ledger as L
from tidelane.operators.table import SyncTable
from tidelane.plans import modes
from tidelane.plans.sync import TablePlan, sync_tables
from tidelane.session import new_folder
from tidelane.streaming.loads import stream_append_only

_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
_PLAN = TablePlan("events", "incremental", "ts")


class _Rows:
    """A source of one table."""

    def __init__(self, rows):
        self.rows = rows

    def read(self, name):
        return self.rows


def _sync(spark, root, ledger, rows, plan=_PLAN):
    (result,) = sync_tables(spark, [plan], _Rows(rows), f"{root}/tables", ledger, "check")
    if not result.success:
        raise RuntimeError(result.error)


@register(_EVENTS)
def stream_new_checkpoint(spark, sf_dir):
    """A stream that starts over with a new checkpoint adds to what the old one loaded."""
    root, events = new_folder(spark, "repeats"), read(spark, sf_dir, "events")
    table = SyncTable(spark, f"{root}/tables", "events")
    for half, where in enumerate(("event_id % 2 = 0", "event_id % 2 = 1")):
        events.where(where).write.parquet(f"{root}/source{half}")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/source{half}")
        stream_append_only(stream, table, f"{root}/checkpoint{half}", "events").awaitTermination()
    return table.refresh().read()


@register(_EVENTS)
def rewrite_then_rerun(spark, sf_dir):
    """The last load died before it was recorded, the table was rewritten, and the load comes again."""
    events, table = read(spark, sf_dir, "events"), SyncTable(spark, new_folder(spark, "repeats"), "events")
    table.create(events.schema)
    first = modes.incremental_load(events.where("ts <= '2024-01-10'"), table, "ts")
    modes.incremental_load(events.where("ts <= '2024-01-20'"), table, "ts", first.cursor)
    table.rewrite()
    modes.incremental_load(events, table, "ts", first.cursor)
    return table.read()


@register(_EVENTS)
def repair_then_rerun(spark, sf_dir):
    """A repair puts the newest lines of a ledger aside, so that it names an older cursor."""
    root, events = new_folder(spark, "repeats"), read(spark, sf_dir, "events")
    for day in ("2024-01-08", "2024-01-16", "2024-01-24"):
        _sync(spark, root, f"{root}/ledger", events.where(F.col("ts") <= day))
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{root}/ledger")
    first = L.read_ledger(spark, f"{root}/ledger").where("event = 'completed'").agg(F.min("at")).head()[0]
    at = F.get_json_object("value", "$.at").cast("timestamp_ntz")
    torn = F.when(at > F.lit(first.isoformat(" ")).cast("timestamp_ntz"), F.expr("left(value, length(value) - 9)"))
    lines.select(F.coalesce(torn, "value")).write.text(f"{root}/torn")
    repaired = L.repair_ledger(spark, f"{root}/torn", f"{root}/repaired")
    _sync(spark, root, repaired.ledger, events)
    return SyncTable(spark, f"{root}/tables", "events").read()


@register(_EVENTS)
def refresh_then_incremental(spark, sf_dir):
    """An incremental table is refreshed as a whole, then loaded by increments again."""
    root, events = new_folder(spark, "repeats"), read(spark, sf_dir, "events")
    _sync(spark, root, f"{root}/ledger", events.where("ts <= '2024-01-08'"))
    whole = TablePlan("events", "full_refresh")
    _sync(spark, root, f"{root}/ledger", events.where("ts <= '2024-01-16'"), whole)
    _sync(spark, root, f"{root}/ledger", events)
    return SyncTable(spark, f"{root}/tables", "events").read()
