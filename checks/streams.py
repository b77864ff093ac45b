"""Streaming loads of the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.ledgers import _KEYS, LEDGER_SQL, ledger_columns
from checks.registry import read, register
from tidelane.operators.table import SyncTable
from tidelane.session import new_folder
from tidelane.streaming import gaps, loads

_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def _stream(spark, sf_dir):
    # A pattern stands for one file as well as for a folder of files.
    return spark.readStream.schema(read(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/event[s].parquet")


@register(_EVENTS)
def stream_append_only(spark, sf_dir):
    root = new_folder(spark, "streams")
    table = SyncTable(spark, f"{root}/tables", "events")
    for _ in range(2):  # the second run finds nothing new
        loads.stream_append_only(_stream(spark, sf_dir), table, f"{root}/checkpoint", "events").awaitTermination()
    return table.read()


@register(_EVENTS)
def stream_scheduled_load(spark, sf_dir):
    root = new_folder(spark, "streams")
    table = SyncTable(spark, f"{root}/tables", "events")
    query = loads.stream_scheduled_load(_stream(spark, sf_dir), table, f"{root}/checkpoint", "events", "1 second")
    query.processAllAvailable()
    query.stop()
    return table.read()


@register("""
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def stream_latest_rows(spark, sf_dir):
    root = new_folder(spark, "streams")
    table = SyncTable(spark, f"{root}/tables", "events")
    # Every row arrives twice, as at-least-once delivery allows.
    twice = _stream(spark, sf_dir).unionAll(_stream(spark, sf_dir))
    return loads.stream_latest_rows(twice, table, f"{root}/checkpoint", "events", ["user_id"], "ts", ["event_id"])


@register("""
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def stream_kept_latest(spark, sf_dir):
    """The latest rows of a stream, kept in buckets; a second stream delivers everything once more."""
    root = new_folder(spark, "streams")
    table = SyncTable(spark, f"{root}/tables", "events")
    for number in range(2):
        query = loads.stream_kept_latest(
            _stream(spark, sf_dir), table, f"{root}/checkpoint-{number}", ["user_id", "event_type"], "ts", ["event_id"], buckets=8
        )
        query.awaitTermination()
    return table.read()


@register(f"""
    WITH done AS (SELECT * FROM ({LEDGER_SQL}) WHERE event = 'completed'),
    g AS (SELECT {_KEYS}, "at", lag("at") OVER (PARTITION BY {_KEYS} ORDER BY "at", run_id) AS gap_from FROM done)
    SELECT {_KEYS}, gap_from, "at" AS gap_to, epoch_us("at") - epoch_us(gap_from) AS gap_us
    FROM g WHERE epoch_us("at") - epoch_us(gap_from) > 86400000000
    UNION ALL
    SELECT {_KEYS}, max("at"), NULL, NULL FROM done GROUP BY 1, 2
    HAVING (SELECT epoch_us(max("at")) FROM done) - epoch_us(max("at")) > 86400000000
""")
def stream_gaps(spark, sf_dir):
    """Gaps told by a stream of ledger events, the open ones at its end included."""
    root = new_folder(spark, "streams")
    table = SyncTable(spark, f"{root}/tables", "gaps")
    alerts = gaps.stream_gaps(_stream(spark, sf_dir).select(ledger_columns()), 43_200, "0 seconds")
    loads.stream_append_only(alerts, table, f"{root}/checkpoint", "gaps").awaitTermination()
    # A gap is told when it opens and again when it ends.
    return table.read().groupBy("connection", "table_name", "gap_from").agg(F.max("gap_to").alias("gap_to"), F.max("gap_us").alias("gap_us"))


@register(_EVENTS)
def stream_drop_repeats(spark, sf_dir):
    root = new_folder(spark, "streams")
    table = SyncTable(spark, f"{root}/tables", "events")
    twice = _stream(spark, sf_dir).unionAll(_stream(spark, sf_dir))
    # The delay spans the whole table, so no row counts as late whatever the order of the files.
    once = loads.drop_repeats(twice, ["event_id"], "ts", "60 days")
    loads.stream_append_only(once, table, f"{root}/checkpoint", "events").awaitTermination()
    return table.read()
