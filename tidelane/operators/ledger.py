"""The run ledger: an append-only table of sync events, and the folds that read a state from it.

Every fold pre-aggregates before its shuffle and keeps one small row per table, so a table with a very
long history costs no more memory than another.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid
from collections.abc import Iterable
from concurrent.futures import Future
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.frames import JSON_TIMES, empty_frame, small_frame
from tidelane.sources.files import child_names, create_file, delete_folder, path_exists, read_text, replace_folder

STARTED, COMPLETED, FAILED = "started", "completed", "failed"
KEYS = ["connection", "table_name"]

LEDGER = T.StructType([
    T.StructField("connection", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("at", T.TimestampNTZType()),
    T.StructField("cursor_old", T.StringType()),
    T.StructField("cursor_new", T.StringType()),
    T.StructField("cursor_type", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("duration_us", T.LongType()),
    T.StructField("error", T.StringType()),
])
_CORRUPT = "_corrupt_record"


class LedgerNeedsConfirmation(Exception):
    """No valid ledger row is left. Starting fresh re-syncs every table, so it must be confirmed."""


def ledger_append(ledger: str, events: DataFrame) -> None:
    """Add events durably. Every append has a folder of its own, so concurrent ones do not collide."""
    ordered = events.select(LEDGER.names)
    ordered.write.options(**JSON_TIMES).option("ignoreNullFields", "false").json(f"{ledger}/{uuid.uuid4().hex}")


def append_lines(spark: SparkSession, ledger: str, events: list[dict]) -> None:
    """Add a few events of the running driver as one file, without a Spark job."""
    lines = []
    for event in events:
        row = {name: event.get(name) for name in LEDGER.names}
        lines.append({k: v.isoformat(timespec="microseconds") if isinstance(v, dt.datetime) else v for k, v in row.items()})
    create_file(spark, f"{ledger}/{uuid.uuid4().hex}.json", "".join(json.dumps(x) + "\n" for x in lines))


class LedgerWriter:
    """Collects the events of a run's tables, so that a file holds all that came since the last one was written.

    An event counts once its future is done. It waits for ``linger`` seconds at most, or for someone else's ``flush``.
    """

    def __init__(self, spark: SparkSession, ledger: str, linger: float = 1.0):
        self._spark, self._ledger, self._linger = spark, ledger, linger
        self._pending: list[tuple[dict, Future]] = []
        self._timer: threading.Timer | None = None
        self._state, self._writing = threading.Lock(), threading.Lock()

    def write(self, event: dict) -> Future:
        done: Future = Future()
        with self._state:
            self._pending.append((event, done))
            if self._timer is None:
                self._timer = threading.Timer(self._linger, self.flush)
                self._timer.daemon = True
                self._timer.start()
        return done

    def flush(self) -> None:
        with self._writing:  # what comes meanwhile goes into the next file
            with self._state:
                taken, self._pending = self._pending, []
                if self._timer is not None:
                    self._timer.cancel()
                    self._timer = None
            if not taken:
                return
            try:
                append_lines(self._spark, self._ledger, [event for event, _ in taken])
            except BaseException as error:
                for _, done in taken:
                    done.set_exception(error)
            else:
                for _, done in taken:
                    done.set_result(None)


def event_rows(spark: SparkSession, events: Iterable[dict]) -> DataFrame:
    """A few events of the running driver as a one-file DataFrame."""
    return small_frame(spark, events, LEDGER)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All events; none when there is no ledger yet. A corrupt ledger is an error, not an empty one."""
    if not path_exists(spark, ledger):
        return empty_frame(spark, LEDGER)
    options = {**JSON_TIMES, "recursiveFileLookup": "true", "mode": "FAILFAST"}
    return spark.read.schema(LEDGER).options(**options).json(ledger)


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.schema(LEDGER).options(**JSON_TIMES, recursiveFileLookup="true", mode="FAILFAST").json(paths)


class _Snapshot(NamedTuple):
    number: int
    events: str  # the folder of the events that still matter
    folded: list[str]  # what they were taken from


def _last_snapshot(spark: SparkSession, ledger: str) -> _Snapshot | None:
    markers = [n for n in child_names(spark, f"{ledger}/_snapshots") if n.endswith(".json")]
    if not markers:
        return None
    row = json.loads(read_text(spark, f"{ledger}/_snapshots/{markers[-1]}"))
    return _Snapshot(int(markers[-1].removesuffix(".json")), row["events"], row["folded"])


def unfolded(spark: SparkSession, ledger: str) -> list[str]:
    """Names of the event files and folders that the last snapshot does not cover."""
    last = _last_snapshot(spark, ledger)
    return sorted(set(child_names(spark, ledger)) - set(last.folded if last else ()))


def read_recent(spark: SparkSession, ledger: str) -> DataFrame:
    """Events that give every fold the same result as all events do: the last snapshot's, and those it does not cover.

    Which those are is told by name, not by time, so late events count as if they had come in time. Old files are not read.
    """
    last = _last_snapshot(spark, ledger)
    paths = [f"{ledger}/{n}" for n in unfolded(spark, ledger)]
    if last is not None:
        paths.append(f"{ledger}/_snapshots/{last.events}")
    # A run that died while merging may have left events twice.
    return _read(spark, paths).distinct() if paths else empty_frame(spark, LEDGER)


def _publish_snapshot(spark: SparkSession, ledger: str, number: int, events: str, folded: list[str]) -> bool:
    text = json.dumps({"events": events, "folded": folded})
    return create_file(spark, f"{ledger}/_snapshots/{number:012}.json", text)


def snapshot_ledger(spark: SparkSession, ledger: str) -> bool:
    """Note which events still matter, so that later runs read those and newer ones only.

    Other runs may add events meanwhile: they are not covered yet. Of two snapshots at once one counts; the result tells.
    """
    last, names = _last_snapshot(spark, ledger), child_names(spark, ledger)
    if not names:
        return False
    folder = uuid.uuid4().hex
    covered = sorted(set(names) | set(last.folded if last else ()))
    paths = [f"{ledger}/{n}" for n in names if last is None or n not in set(last.folded)]
    if last is not None:
        paths.append(f"{ledger}/_snapshots/{last.events}")
    kept = resume_events(_read(spark, paths).distinct()).hint("rebalance")
    kept.write.options(**JSON_TIMES).option("ignoreNullFields", "false").json(f"{ledger}/_snapshots/{folder}")
    if not _publish_snapshot(spark, ledger, last.number + 1 if last else 1, folder, covered):
        delete_folder(spark, f"{ledger}/_snapshots/{folder}")
        return False
    if last is not None:  # readers that began with it may still finish; the one before it is gone by now
        for name in child_names(spark, f"{ledger}/_snapshots"):
            if name not in (folder, last.events) and (not name.endswith(".json") or int(name.removesuffix(".json")) < last.number):
                delete_folder(spark, f"{ledger}/_snapshots/{name}")
    return True


def is_valid_event(line: Column) -> Column:
    """Whether a ledger line is JSON of the ledger's columns and names a table and an event."""
    schema = T.StructType([*LEDGER.fields, T.StructField(_CORRUPT, T.StringType())])
    event = F.from_json(line, schema, {**JSON_TIMES, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    whole = event[_CORRUPT].isNull() & event["table_name"].isNotNull() & event["at"].isNotNull()
    return F.coalesce(whole & event["event"].isin(STARTED, COMPLETED, FAILED), F.lit(False))


class Repaired(NamedTuple):
    ledger: str
    quarantine: str
    has_events: bool


def repair_ledger(spark: SparkSession, ledger: str, target: str, confirm_fresh: bool = False) -> Repaired:
    """Split a ledger's lines, unchanged and in one pass, into a new ledger and a quarantine below ``target``.

    When no valid event is left, the new ledger is empty. That is accepted only if confirmed, since every
    table is then read again from its start; destinations have to be published as new versions first.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(ledger)
    lines.withColumn("valid", is_valid_event(F.col("value"))).write.partitionBy("valid").text(target)
    repaired = Repaired(f"{target}/valid=true", f"{target}/valid=false", path_exists(spark, f"{target}/valid=true"))
    if not repaired.has_events and not confirm_fresh:
        raise LedgerNeedsConfirmation(f"no valid event in {ledger}; its lines are kept in {repaired.quarantine}")
    return repaired


def compact_ledger(spark: SparkSession, ledger: str, compacted: str) -> None:
    """Copy all events into a new ledger of few files, once many runs have left many small ones."""
    ledger_append(compacted, read_ledger(spark, ledger).hint("rebalance"))


def compact_in_place(spark: SparkSession, ledger: str) -> None:
    """Replace the event folders a ledger has now by one. Run it while no other run uses the ledger.

    The new folder becomes visible in one step, before the old ones are deleted. A run that dies in between leaves
    events twice, which moves no cursor; the next compaction drops the repeats.
    """
    before = child_names(spark, ledger)
    if len(before) < 2:
        return
    events = read_ledger(spark, ledger).distinct()
    aside = f"{ledger}/_compacted-{uuid.uuid4().hex}"
    events.write.options(**JSON_TIMES).option("ignoreNullFields", "false").json(aside)
    merged = uuid.uuid4().hex
    snapshot = snapshot_ledger(spark, ledger) and _last_snapshot(spark, ledger) if _last_snapshot(spark, ledger) else None
    replace_folder(spark, aside, f"{ledger}/{merged}")
    if snapshot:  # it covers the same events under their new name
        _publish_snapshot(spark, ledger, snapshot.number + 1, snapshot.events, [merged])
    for name in before:
        delete_folder(spark, f"{ledger}/{name}")


# -- folds ----------------------------------------------------------------------------------------


def event_order() -> Column:
    """Total order of events: time, then run, then start before end within a run."""
    return F.struct("at", "run_id", (F.col("event") != STARTED).alias("is_end"))


def _last(event: str) -> Column:
    return F.max(F.when(F.col("event") == event, event_order()))


def safe_cursor(ledger: DataFrame) -> DataFrame:
    """Where each table resumes: the cursor of its last completed run, whatever happened since."""
    done = ledger.where(F.col("event") == COMPLETED)
    newest = F.max(F.struct(event_order().alias("o"), "cursor_new", "cursor_type"))
    return done.groupBy(KEYS).agg(newest.alias("n")).select(
        *KEYS, F.col("n.cursor_new").alias("cursor_value"), F.col("n.cursor_type").alias("cursor_type")
    )


def _ends(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy(KEYS).agg(_last(STARTED).alias("s"), _last(COMPLETED).alias("c"), _last(FAILED).alias("f"))


def needs_resume(ledger: DataFrame) -> DataFrame:
    """Whether each table's last start was never completed, by a crash or by a failure."""
    unfinished = F.col("s").isNotNull() & (F.col("c").isNull() | (F.col("s") > F.col("c")))
    return _ends(ledger).select(*KEYS, unfinished.alias("needs_resume"))


def _with_failures(folded: DataFrame, ledger: DataFrame, salts: int) -> DataFrame:
    """Add each table's failures after its last completed run, ``completed_order`` of ``folded``.

    The folded rows are joined back to the failures. Both sides carry a salt, so that a table with very
    many failures is spread over several tasks and only its counts come together. The folded side has
    one row per table and salt, so a task's share of it is hashed and the failures need no sort.
    """
    columns = folded.columns
    spread = folded.withColumn("salt", F.explode(F.array(*map(F.lit, range(salts)))))
    failed = ledger.where(F.col("event") == FAILED).select(
        *(F.col(k).alias(f"failed_{k}") for k in KEYS), event_order().alias("failed_order"),
        F.pmod(F.xxhash64("at", "run_id"), F.lit(salts)).cast("int").alias("failed_salt"),
    )
    later = F.col("completed_order").isNull() | (F.col("failed_order") > F.col("completed_order"))
    same = (F.col("salt") == F.col("failed_salt")) & later
    for k in KEYS:
        same &= F.col(k) == F.col(f"failed_{k}")
    return spread.hint("shuffle_hash").join(failed, same, "left").groupBy(columns).agg(
        F.count("failed_order").alias("consecutive_failures")
    )


def resume_events(ledger: DataFrame, salts: int = 16) -> DataFrame:
    """The events that still matter to every fold: each table's last start and last end, and the failures after it.

    Taking them of two ledgers apart, and then of both results together, gives what taking them of all events gives. So
    a ledger can be folded piece by piece, in any order, late events included.
    """
    whole = F.struct(event_order().alias("o"), F.struct(*LEDGER.names).alias("e"))
    newest = {e: F.max(F.when(F.col("event") == e, whole)).alias(e) for e in (STARTED, COMPLETED)}
    folded = ledger.groupBy(KEYS).agg(*newest.values())
    ends = F.array_compact(F.array(F.col(f"{STARTED}.e"), F.col(f"{COMPLETED}.e")))
    spread = folded.select(
        *(F.col(k).alias(f"folded_{k}") for k in KEYS), F.col(f"{COMPLETED}.o").alias("completed_order"),
        F.explode(F.array(*map(F.lit, range(salts)))).alias("folded_salt"),
    )
    failed = ledger.where(F.col("event") == FAILED).withColumn("salt", F.pmod(F.xxhash64("at", "run_id"), F.lit(salts)).cast("int"))
    same = F.col("salt") == F.col("folded_salt")
    for k in KEYS:
        same &= F.col(k).eqNullSafe(F.col(f"folded_{k}"))
    later = F.col("completed_order").isNull() | (event_order() > F.col("completed_order"))
    failures = failed.join(spread.hint("shuffle_hash"), same).where(later).select(LEDGER.names)
    return folded.select(F.inline(ends)).unionAll(failures)


def consecutive_failures(ledger: DataFrame, salts: int = 16) -> DataFrame:
    """Failures since each table's last completed run."""
    folded = ledger.groupBy(KEYS).agg(_last(COMPLETED).alias("completed_order"))
    return _with_failures(folded, ledger, salts).drop("completed_order")


def ledger_state(ledger: DataFrame, salts: int = 16) -> DataFrame:
    """Current state of each table: status, times, cursors, rows of the last success, failure streak."""
    running = (F.col("event") == STARTED)
    done = (F.col("event") == COMPLETED)
    order = event_order()
    folded = ledger.groupBy(KEYS).agg(
        F.max(F.struct(order.alias("o"), "event")).alias("last"),
        F.max(F.when(running, F.struct(order.alias("o"), "cursor_old"))).alias("s"),
        F.max(F.when(done, F.struct(order.alias("o"), "cursor_new", "cursor_type", "rows"))).alias("c"),
    )
    status = (
        F.when(F.col("last.event") == STARTED, "running")
        .when(F.col("last.event") == COMPLETED, "success")
        .otherwise("failed")
    )
    restarted = F.col("c").isNull() | (F.col("s").isNotNull() & (F.col("s.o") > F.col("c.o")))
    state = folded.select(
        *KEYS, status.alias("status"),
        F.col("s.o.at").alias("last_sync_started"),
        F.when(~restarted, F.col("c.o.at")).alias("last_sync_completed"),
        F.col("c.cursor_new").alias("cursor_value"), F.col("c.cursor_type").alias("cursor_type"),
        F.when(F.col("last.event") == STARTED, F.col("s.cursor_old")).alias("cursor_in_progress"),
        F.coalesce("c.rows", F.lit(0)).cast("bigint").alias("rows_synced_last_run"),
        F.col("c.o").alias("completed_order"),
    )
    return _with_failures(state, ledger, salts).drop("completed_order")
