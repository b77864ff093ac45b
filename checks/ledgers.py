"""Folds over a run ledger. Events stand for sync events: each user is a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import read, register
from tidelane.frames import JSON_TIMES
from tidelane.operators import ledger as L
from tidelane.session import new_folder

# Errors are failed runs, purchases completed ones, all else starts.
_LEDGER = """
    CASE WHEN user_id < 50 THEN 'prod' ELSE 'test' END AS connection,
    concat('t', CAST(user_id AS STRING)) AS table_name,
    lpad(CAST(event_id AS STRING), 12, '0') AS run_id,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' ELSE 'started' END AS event,
    ts AS at,
    CAST(event_id - 1 AS STRING) AS cursor_old,
    CASE WHEN event_type <> 'view' THEN CAST(event_id AS STRING) END AS cursor_new,
    'bigint' AS cursor_type,
    event_id * 7 AS rows,
    CAST(CAST(value AS DECIMAL(18, 2)) * 100 AS BIGINT) * 54321 AS duration_us,
    CASE WHEN event_type = 'error' THEN concat('dial db://u:p@h', CAST(user_id AS STRING), '/x failed') END AS error
"""
LEDGER_SQL = f"SELECT {_LEDGER} FROM events".replace("AS STRING", "AS VARCHAR").replace("AS at", 'AS "at"')
_KEYS = "connection, table_name"


def ledger_columns():
    return [F.expr(c) for c in _LEDGER.strip().split(",\n")]


def ledger(spark, sf_dir):
    return read(spark, sf_dir, "events").select(ledger_columns())


_NEWEST = f"""
    l AS ({LEDGER_SQL}),
    done AS (SELECT * FROM l WHERE event = 'completed'
             QUALIFY row_number() OVER (PARTITION BY {_KEYS} ORDER BY "at" DESC, run_id DESC) = 1),
    begun AS (SELECT * FROM l WHERE event = 'started'
              QUALIFY row_number() OVER (PARTITION BY {_KEYS} ORDER BY "at" DESC, run_id DESC) = 1),
    newest AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY {_KEYS} ORDER BY "at" DESC, run_id DESC) = 1),
    streak AS (
        SELECT {_KEYS}, CAST(count(*) FILTER (event = 'failed' AND later) AS BIGINT) AS consecutive_failures
        FROM (SELECT l.*, done."at" IS NULL OR l."at" > done."at" AS later FROM l LEFT JOIN done USING ({_KEYS}))
        GROUP BY {_KEYS}
    )
"""


@register(f"WITH {_NEWEST} SELECT {_KEYS}, cursor_new AS cursor_value, cursor_type FROM done")
def safe_cursor(spark, sf_dir):
    return L.safe_cursor(ledger(spark, sf_dir))


@register(f"""
    WITH {_NEWEST}
    SELECT {_KEYS}, begun."at" IS NOT NULL AND (done."at" IS NULL OR begun."at" > done."at") AS needs_resume
    FROM newest LEFT JOIN begun USING ({_KEYS}) LEFT JOIN done USING ({_KEYS})
""")
def needs_resume(spark, sf_dir):
    return L.needs_resume(ledger(spark, sf_dir))


@register(f"WITH {_NEWEST} SELECT * FROM streak")
def consecutive_failures(spark, sf_dir):
    return L.consecutive_failures(ledger(spark, sf_dir))


@register(f"""
    WITH {_NEWEST}
    SELECT {_KEYS},
           CASE newest.event WHEN 'started' THEN 'running' WHEN 'completed' THEN 'success' ELSE 'failed' END AS status,
           begun."at" AS last_sync_started,
           CASE WHEN begun."at" IS NULL OR begun."at" < done."at" THEN done."at" END AS last_sync_completed,
           done.cursor_new AS cursor_value, done.cursor_type AS cursor_type,
           CASE WHEN newest.event = 'started' THEN newest.cursor_old END AS cursor_in_progress,
           coalesce(done.rows, 0) AS rows_synced_last_run, consecutive_failures
    FROM newest LEFT JOIN begun USING ({_KEYS}) LEFT JOIN done USING ({_KEYS}) JOIN streak USING ({_KEYS})
""")
def ledger_state(spark, sf_dir):
    return L.ledger_state(ledger(spark, sf_dir))


@register(f"""
    WITH {_NEWEST}
    SELECT {_KEYS}, done.cursor_new AS cursor_value, tried.cursor_new AS failed_cursor
    FROM done JOIN (
        SELECT * FROM l WHERE event = 'failed'
        QUALIFY row_number() OVER (PARTITION BY {_KEYS} ORDER BY "at" DESC, run_id DESC) = 1
    ) tried USING ({_KEYS})
    WHERE tried."at" > done."at"
""")
def failed_keeps_cursor(spark, sf_dir):
    """Tables whose last failure came after their last success: where they resume, and where the failure stood."""
    events = ledger(spark, sf_dir)
    tried = events.where("event = 'failed'").groupBy(L.KEYS).agg(
        F.max(F.struct("at", "run_id", "cursor_new")).alias("f")
    )
    failing = L.consecutive_failures(events).where("consecutive_failures > 0")
    return (
        L.safe_cursor(events).join(failing, L.KEYS).join(tried, L.KEYS)
        .select(*L.KEYS, "cursor_value", F.col("f.cursor_new").alias("failed_cursor"))
    )


@register(LEDGER_SQL)
def ledger_append(spark, sf_dir):
    path, events = new_folder(spark, "ledger"), ledger(spark, sf_dir)
    for event in (L.STARTED, L.COMPLETED, L.FAILED):
        L.ledger_append(path, events.where(F.col("event") == event))
    return L.read_ledger(spark, path)


# A third of the runs left a line that is no event: cut short, not JSON, or without its table.
_BROKEN = "event_type = 'view' OR event_type = 'click'"


def _broken_ledger(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    told = events.select("event_type", F.struct(*ledger_columns()).alias("e"))
    line = F.to_json("e", JSON_TIMES)
    return told.select(
        F.when(F.col("event_type") == "view", F.left(line, F.lit(24)))
        .when(F.col("event_type") == "click", "not json at all {{{")
        .otherwise(line).alias("value")
    )


@register(f"SELECT * FROM ({LEDGER_SQL}) WHERE run_id NOT IN (SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') FROM events WHERE {_BROKEN})")
def quarantine_corrupt_ledger(spark, sf_dir):
    root = new_folder(spark, "ledger")
    _broken_ledger(spark, sf_dir).write.text(f"{root}/ledger")
    return L.read_ledger(spark, L.repair_ledger(spark, f"{root}/ledger", f"{root}/repaired").ledger)


@register(f"""
    WITH {_NEWEST}
    SELECT {_KEYS},
           CASE newest.event WHEN 'started' THEN 'running' WHEN 'completed' THEN 'success' ELSE 'failed' END AS status,
           done.cursor_new AS cursor_value, begun."at" IS NOT NULL AND (done."at" IS NULL OR begun."at" > done."at") AS needs_resume,
           consecutive_failures
    FROM newest LEFT JOIN begun USING ({_KEYS}) LEFT JOIN done USING ({_KEYS}) JOIN streak USING ({_KEYS})
""")
def ledger_snapshots(spark, sf_dir):
    """A ledger whose events come out of order, folded by snapshots in between; old files are not read again."""
    root, events = new_folder(spark, "ledger"), ledger(spark, sf_dir)
    for number in (2, 0, 3, 1):
        L.ledger_append(root, events.where(f"pmod(xxhash64(run_id), 4) = {number}"))
        if number != 1:
            L.snapshot_ledger(spark, root)
    recent = L.read_recent(spark, root)
    state = L.ledger_state(recent).select(*L.KEYS, "status", "cursor_value", "consecutive_failures")
    return state.join(L.needs_resume(recent), L.KEYS)


@register(LEDGER_SQL)
def compact_ledger(spark, sf_dir):
    """Events appended by day, then merged, twice over for the last day as after a run that died while merging."""
    root, events = f"{new_folder(spark, 'ledger')}/ledger", ledger(spark, sf_dir)
    late = F.col("at") > F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (events.where(~late), events.where(late), events.where(late)):
        L.ledger_append(root, part)
    L.compact_in_place(spark, root)
    return L.read_ledger(spark, root)


@register(f"""
    SELECT CASE event_type WHEN 'click' THEN 'not json at all {{{{{{'
           ELSE '{{"connection":"' || CASE WHEN user_id < 50 THEN 'prod' ELSE 'test' END || '","ta' END AS line
    FROM events WHERE {_BROKEN}
""")
def quarantined_lines(spark, sf_dir):
    """What was set aside, as it stood in the ledger."""
    root = new_folder(spark, "ledger")
    _broken_ledger(spark, sf_dir).write.text(f"{root}/ledger")
    kept = spark.read.text(L.repair_ledger(spark, f"{root}/ledger", f"{root}/repaired").quarantine)
    return kept.withColumnRenamed("value", "line")


@register("""
    SELECT concat('t', CAST(c_custkey AS VARCHAR)) AS table_name, CAST(NULL AS VARCHAR) AS cursor_value,
           CAST(0 AS BIGINT) AS consecutive_failures
    FROM customer
""")
def first_run_empty(spark, sf_dir):
    """Without a ledger every table starts from nothing; that is no error."""
    tables = read(spark, sf_dir, "customer").select(F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("table_name"))
    state = L.ledger_state(L.read_ledger(spark, new_folder(spark, "ledger")))
    return tables.join(state, "table_name", "left").select(
        "table_name", "cursor_value", F.coalesce("consecutive_failures", F.lit(0)).cast("bigint").alias("consecutive_failures")
    )
