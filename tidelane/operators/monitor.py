"""Reports on runs and drift, and checks of sync plans. Each report is a DataFrame, one row per line item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelane.functions.text import credential_field, format_duration, mask, may_hold_credentials, redact_urls
from tidelane.operators.ledger import COMPLETED, FAILED, KEYS, STARTED, event_order
from tidelane.operators.schema import ADD_COLUMN, REMOVE_COLUMN, TYPE_INCOMPATIBLE, TYPE_WIDEN

# Sync modes, and those that need a cursor.
SYNC_MODES = ("incremental", "full_refresh", "append_only")
CURSOR_MODES = ("incremental", "append_only")


def failure_report(results: DataFrame) -> DataFrame:
    """One entry per failed table of a run and one total per run (``table_name`` NULL).

    ``results``: ``run_id, table_name, success, duration_us, error``. Connection strings in errors are
    redacted.
    """
    failed = results.where(~F.col("success"))
    # The report's lines.
    entry = F.concat(
        F.lit("Table: "), "table_name",
        F.lit("\n  Duration: "), format_duration(F.col("duration_us")),
        F.coalesce(F.concat(F.lit("\n  Error: "), redact_urls(F.col("error"))), F.lit("")),
    )
    entries = failed.select("run_id", "table_name", entry.alias("report"))
    totals = failed.groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).select(
        "run_id", F.lit(None).cast("string").alias("table_name"),
        F.concat(F.lit("Total failed tables: "), F.col("n").cast("string")).alias("report"),
    )
    return entries.unionAll(totals)


def schema_change_report(changes: DataFrame) -> DataFrame:
    """One line per schema change, and a banner (``name`` NULL) for each halted table."""
    change = F.col("change_type")
    arrow = F.concat(F.lit(" ("), "old_type", F.lit(" → "), "new_type", F.lit(")"))
    # The report's lines.
    line = (
        F.when(change == ADD_COLUMN, F.concat(F.lit("  + Added column: "), "name", F.lit(" ("), "new_type", F.lit(")")))
        .when(change == REMOVE_COLUMN,
              F.concat(F.lit("  - Removed column: "), "name", F.lit(" (was "), "old_type", F.lit(")")))
        .when(change == TYPE_WIDEN, F.concat(F.lit("  ↑ Type widened: "), "name", arrow))
        .when(change == TYPE_INCOMPATIBLE, F.concat(F.lit("  ⛔ Incompatible type change: "), "name", arrow))
    )
    banner = "⛔ INCOMPATIBLE CHANGES DETECTED — sync halted for this table"
    entries = F.array_compact(F.array(
        F.struct("name", line.alias("line")),
        F.when(change == TYPE_INCOMPATIBLE, F.struct(F.lit(None).cast("string").alias("name"), F.lit(banner).alias("line"))),
    ))
    # Each change brings its line and, if need be, its table's banner, so the changes are found only once; a column
    # has one change, so only banners repeat.
    return changes.select("table_name", F.inline(entries)).distinct()


def micros(at: Column) -> Column:
    """Microseconds of a time without zone, so that no daylight saving of the session bends a distance."""
    seconds = F.unix_date(at.cast("date")).cast("bigint") * 86_400 + F.hour(at) * 3600 + F.minute(at) * 60
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), at) * 1_000_000).cast("bigint")


def sync_gaps(ledger: DataFrame, interval_seconds: int) -> DataFrame:
    """Past stretches longer than twice the interval without a completed run, per table.

    Runs are first folded into time buckets as long as the limit. Two runs in one bucket are never too
    far apart, so a gap can only lie between a bucket's last run and the next bucket's first. Only
    those bucket rows are ordered, however many runs a table has.
    """
    limit = 2 * interval_seconds * 1_000_000
    buckets = (
        ledger.where(F.col("event") == COMPLETED)
        .groupBy(*KEYS, F.floor(micros(F.col("at")) / limit).alias("bucket"))
        .agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    )
    order = W.partitionBy(KEYS).orderBy("bucket")
    return (
        buckets.withColumn("gap_from", F.lag("last_at").over(order))
        .withColumn("gap_us", micros(F.col("first_at")) - micros(F.col("gap_from")))
        .where(F.col("gap_us") > limit)
        .select(*KEYS, "gap_from", F.col("first_at").alias("gap_to"), "gap_us")
    )


def overdue_tables(ledger: DataFrame, interval_seconds: int, now: Column) -> DataFrame:
    """Tables whose last completed run is older than twice the interval."""
    last = ledger.where(F.col("event") == COMPLETED).groupBy(KEYS).agg(F.max("at").alias("last_completed"))
    return last.where(now - F.col("last_completed") > F.make_dt_interval(secs=F.lit(2 * interval_seconds)))


def literal_credential_scan(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Lines that put a literal value into a credential setting, as ``(key, line_no, field)``."""
    lines = texts.where(may_hold_credentials(F.col(text))).select(
        key, F.posexplode(F.split(text, "\n")).alias("position", "line")
    )
    return (
        lines.select(key, (F.col("position") + 1).alias("line_no"), credential_field(F.col("line")).alias("field"))
        .where(F.col("field").isNotNull())
    )


def validate_plan(plan: DataFrame) -> DataFrame:
    """Every broken rule of each plan row; ``rule_no`` 1 is the one a reader should fix first.

    ``plan``: ``position, name, sync_mode, cursor_field``. Empty and NULL mean missing.
    """
    def missing(column: str) -> Column:
        return F.coalesce(F.col(column) == "", F.lit(True))

    at = F.concat(F.lit("sync.tables["), F.col("position").cast("string"), F.lit("]"))
    modes = ", ".join(SYNC_MODES)
    # The messages.
    rules = F.array(
        F.when(missing("name"), F.concat(at, F.lit(".name is required"))),
        F.when(missing("sync_mode"), F.concat(at, F.lit(".sync_mode is required"))),
        F.when(
            ~missing("sync_mode") & ~F.col("sync_mode").isin(*SYNC_MODES),
            F.concat(at, F.lit('.sync_mode "'), "sync_mode", F.lit(f'" is invalid (valid: {modes})')),
        ),
        F.when(
            F.col("sync_mode").isin(*CURSOR_MODES) & missing("cursor_field"),
            F.concat(at, F.lit(" ("), F.coalesce("name", F.lit("")), F.lit("): cursor_field is required for "),
                     "sync_mode", F.lit(" mode")),
        ),
    )
    return (
        plan.select("position", F.posexplode(F.array_compact(rules)).alias("rule", "violation"))
        .select("position", (F.col("rule") + 1).alias("rule_no"), "violation")
    )


def missing_tables(plan: DataFrame, tables: DataFrame) -> DataFrame:
    """Planned tables that the source does not have."""
    return plan.join(tables.select(F.col("table_name").alias("name")).distinct(), "name", "left_anti")


def mask_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Replace the named columns by a constant mask."""
    return df.withColumns({c: mask() for c in columns})


def run_summary(ledger: DataFrame) -> DataFrame:
    """Per run: tables finished and failed, rows, durations, and the exit code a caller would report."""
    done, failed = F.col("event") == COMPLETED, F.col("event") == FAILED
    return ledger.where(F.col("event") != STARTED).groupBy("run_id").agg(
        F.count_if(done).alias("succeeded"),
        F.count_if(failed).alias("failed"),
        F.coalesce(F.sum(F.when(done, F.col("rows"))), F.lit(0)).cast("bigint").alias("rows_synced"),
        F.sum("duration_us").alias("total_us"),
        F.max("duration_us").alias("longest_us"),
        F.max(failed.cast("int")).alias("exit_code"),
    )


def latest_attempt(ledger: DataFrame) -> DataFrame:
    """The last finished attempt of each table, in the form ``failure_report`` takes."""
    ended = ledger.where(F.col("event") != STARTED)
    newest = F.max(F.struct(event_order().alias("o"), "run_id", "event", "duration_us", "error"))
    return ended.groupBy(KEYS).agg(newest.alias("n")).select(
        "n.run_id", "table_name", (F.col("n.event") == COMPLETED).alias("success"), "n.duration_us", "n.error"
    )
