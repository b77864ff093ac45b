"""One run over many tables: concurrent loads with isolated failures, recorded in the ledger."""

from __future__ import annotations

import datetime as dt
import threading
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, fields, replace
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.frames import small_frame
from tidelane.functions.text import is_fatal_message
from tidelane.operators import ledger as L
from tidelane.operators.commits import ConcurrentWrite
from tidelane.operators.monitor import CURSOR_MODES, SYNC_MODES
from tidelane.operators.schema import TYPE_INCOMPATIBLE, IncompatibleSchema, apply_changes, changed_columns
from tidelane.operators.table import SyncTable
from tidelane.plans.modes import EXACTLY_ONCE, LoadResult, full_refresh, incremental_load
from tidelane.sources.connectors import Source
from tidelane.sources.files import child_names
from tidelane.sources.scan import Cursor
from tidelane.types import stored_schema

DEFAULT_TIMEOUT_MINUTES = 30
DEFAULT_ATTEMPTS = 3
PLAN_KEYS = ("name", "sync_mode")


@dataclass(frozen=True)
class TablePlan:
    name: str
    sync_mode: str
    cursor_field: str | None = None
    destination_table: str | None = None
    timeout_minutes: float = 0
    lookback: Any = None  # a number or timedelta: how far an increment reads back behind its cursor
    sort_by_cursor: bool = False
    strict_items: bool = False
    rebalance: bool = False
    tie_keys: tuple[str, ...] | None = None  # what tells rows of one cursor value apart, for tie-safe increments

    @property
    def destination(self) -> str:
        return self.destination_table or self.name

    @property
    def timeout(self) -> float:
        return 60 * (self.timeout_minutes if self.timeout_minutes > 0 else DEFAULT_TIMEOUT_MINUTES)


@dataclass(frozen=True)
class TableResult:
    table_name: str
    success: bool
    rows: int = 0
    duration_us: int = 0
    error: str | None = None
    changes: tuple = ()


RESULTS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("rows", T.LongType()),
    T.StructField("duration_us", T.LongType()),
    T.StructField("error", T.StringType()),
])


class TableTimeout(Exception):
    pass


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def with_retry(task: Callable[[], LoadResult], attempts: int = DEFAULT_ATTEMPTS, wait: Callable = time.sleep):
    """Run a load again after 1 s, 2 s, ... until it works, its error is fatal, or attempts run out.

    Spark retries single tasks by itself; this covers errors of the whole job, such as a lost source.
    """
    for attempt in range(1, attempts + 1):
        try:
            return task()
        except TableTimeout:
            raise
        except Exception as error:
            if isinstance(error, (ConcurrentWrite, IncompatibleSchema)) or is_fatal_message(str(error)):
                raise RuntimeError(f"fatal, not tried again: {error}") from error
            if attempt == attempts:
                raise RuntimeError(f"gave up after {attempts} attempts: {error}") from error
            wait(2 ** (attempt - 1))


class _Deadline:
    """Cancels the Spark jobs a thread started once its time is up."""

    def __init__(self, spark: SparkSession, seconds: float):
        self._spark, self._context = spark, spark.sparkContext
        self._tag = f"tidelane-{uuid.uuid4().hex}"
        self._seconds = seconds
        self._over = threading.Event()
        self._timer = threading.Timer(seconds, self._expire)

    def _expire(self) -> None:
        self._over.set()
        self._context.cancelJobsWithTag(self._tag)

    def __enter__(self) -> _Deadline:
        self._context.setInterruptOnCancel(True)
        self._context.addJobTag(self._tag)
        self._ends = time.monotonic() + self._seconds
        self._timer.start()
        return self

    def __exit__(self, kind, error, trace) -> None:
        self._timer.cancel()
        self._context.removeJobTag(self._tag)

    def check(self) -> None:
        if self._over.is_set():
            raise TableTimeout(f"deadline exceeded after {self._seconds:g} s")

    def run(self, step: Callable):
        """One step of a load, which counts only if it ends before the deadline."""
        self.check()
        try:
            done = step()
        except Exception:
            self.check()
            raise
        self.check()
        return done

    def open(self, step: Callable):
        """A step that may hang outside Spark and changes nothing: it is left behind when time is up."""
        done: list = []

        def attempt():
            try:
                done.append((step(), None))
            except Exception as error:
                done.append((None, error))

        thread = threading.Thread(target=inheritable_thread_target(self._spark)(attempt), daemon=True)
        thread.start()
        thread.join(max(0.0, self._ends - time.monotonic()))
        if not done:
            self._over.wait(1)
            raise TableTimeout(f"deadline exceeded after {self._seconds:g} s")
        value, error = done[0]
        if error is not None:
            self.check()
            raise error
        return value


def sync_tables(
    spark: SparkSession, plan: Iterable[TablePlan] | DataFrame, source: Source, destination: str, ledger: str,
    connection: str, *, run_id: str | None = None, clock: Callable[[], dt.datetime] = utc_now,
    parallel_tables: int = 8, attempts: int = DEFAULT_ATTEMPTS, wait: Callable = time.sleep,
    delivery: str = EXACTLY_ONCE, records_per_file: int = 0, compact_ledger_above: int = 0, snapshot_ledger_above: int = 500,
) -> list[TableResult]:
    """Sync every planned table and return one result for each; a failure stays with its table.

    Each table is opened, compared, loaded and recorded by one worker, under one deadline. Starts are
    recorded before rows are read, ends only after the write is done, so after a crash the next run begins at the
    last completed cursor. Only the plan, schemas and one-row counts pass through the driver. A ledger of more than
    ``compact_ledger_above`` event files (0: never) is compacted first; no other run may use it then. With more than
    ``snapshot_ledger_above`` files since its last snapshot, a new one is taken first; other runs may go on.
    """
    if isinstance(plan, DataFrame):
        own = [f.name for f in fields(TablePlan) if f.name in plan.columns]
        rows = (row.asDict() for row in plan.select(*own).collect())
        plan = [TablePlan(**{k: v for k, v in row.items() if v is not None or k in PLAN_KEYS}) for row in rows]
    plan = list(plan)
    run = _Run(spark, source, destination, ledger, connection, run_id or uuid.uuid4().hex, clock,
               attempts, wait, delivery, records_per_file)
    if compact_ledger_above and len(child_names(spark, ledger)) > compact_ledger_above:
        run.keep_up(L.compact_in_place)
    if snapshot_ledger_above and len(L.unfolded(spark, ledger)) > snapshot_ledger_above:
        run.keep_up(L.snapshot_ledger)
    run.read_cursors(plan)
    taken: set[str] = set()
    tasks = []
    for p in plan:
        refused = f"destination {p.destination} is planned twice" if p.destination in taken else None
        taken.add(p.destination)
        tasks.append(_Prepared(p, SyncTable(spark, destination, p.destination), refused, run.cursors.get(p.name)))
    with ThreadPoolExecutor(parallel_tables) as pool:
        # Wrapped once for each table: threads of one wrapper share their job tags, and a deadline would end them all.
        running = [pool.submit(inheritable_thread_target(spark)(run.sync), task) for task in tasks]
    run.events.flush()
    return [run.recorded(*r.result()) for r in running]


def results_frame(spark: SparkSession, run_id: str, results: Iterable[TableResult]) -> DataFrame:
    """Results in the form ``failure_report`` takes."""
    return small_frame(spark, [{"run_id": run_id, **vars(r)} for r in results], RESULTS)


@dataclass
class _Prepared:
    plan: TablePlan
    table: SyncTable
    error: str | None = None
    cursor: Cursor | None = None
    rows: DataFrame | None = None
    changes: tuple = ()


class _Run:
    def __init__(self, spark, source, destination, ledger, connection, run_id, clock, attempts, wait, delivery,
                 records_per_file):
        self.spark, self.source, self.destination, self.ledger = spark, source, destination, ledger
        self.connection, self.run_id, self.clock = connection, run_id, clock
        self.attempts, self.wait, self.delivery = attempts, wait, delivery
        self.records_per_file = records_per_file
        self.cursors: dict[str, Cursor] = {}
        self.unreadable: str | None = None
        self.events = L.LedgerWriter(spark, ledger)

    def keep_up(self, step: Callable) -> None:
        try:
            step(self.spark, self.ledger)
        except Exception:
            pass  # an upkeep step; a ledger that cannot be read is reported for each table below

    def read_cursors(self, plan: list[TablePlan]) -> None:
        """Where the planned tables resume. A ledger that cannot be read fails each of them."""
        names = T.StructType([T.StructField("table_name", T.StringType())])
        planned = small_frame(self.spark, [{"table_name": p.name} for p in plan], names)
        try:
            events = L.read_recent(self.spark, self.ledger).where(F.col("connection") == self.connection)
            state = L.safe_cursor(events.join(planned, "table_name", "left_semi"))
            self.cursors = {
                r["table_name"]: Cursor(r["cursor_value"], r["cursor_type"])
                for r in state.collect() if r["cursor_value"] is not None
            }
        except Exception as error:
            self.unreadable = f"the ledger cannot be read: {error}"

    def recorded(self, result: TableResult, written: Future | None) -> TableResult:
        """A result as it stands once its last event is in the ledger, or is known not to be."""
        try:
            if written is not None:
                written.result()
            return result
        except Exception as error:  # the other tables' results must not be lost with it
            told = f"the ledger could not be written: {error}"
            return replace(result, success=False, rows=0, error=told if result.error is None else f"{result.error}; and {told}")

    def sync(self, p: _Prepared) -> tuple[TableResult, Future | None]:
        # Under fair scheduling each table has a pool of its own, so a large one does not starve the rest.
        self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", p.plan.destination)
        self.spark.sparkContext.setJobDescription(f"sync {p.plan.name}")
        started = time.monotonic()
        try:
            self._check_plan(p)
            with _Deadline(self.spark, p.plan.timeout) as deadline:
                late = None
                try:
                    deadline.open(lambda: self._open(p))
                except TableTimeout as error:
                    late = error  # begun all the same
                begun = self.events.write(self._event(p, L.STARTED))
                self.events.flush()
                begun.result()
                if late is not None:
                    raise late
                deadline.run(lambda: self._fit_schema(p))
                done = with_retry(lambda: deadline.run(lambda: self._load_once(p)), self.attempts, self.wait)
            took = int((time.monotonic() - started) * 1_000_000)
            new = done.cursor or p.cursor or Cursor(None, None)
            event = self._event(p, L.COMPLETED, rows=done.rows, duration_us=took, cursor_new=new.value)
            written = self.events.write(event | {"cursor_type": new.type})
            return TableResult(p.plan.name, True, done.rows, took, None, p.changes), written
        except Exception as error:
            took, told, written = int((time.monotonic() - started) * 1_000_000), str(error), None
            if self.unreadable is None:
                written = self.events.write(self._event(p, L.FAILED, duration_us=took, error=told))
            return TableResult(p.plan.name, False, 0, took, told, p.changes), written

    def _check_plan(self, p: _Prepared) -> None:
        if p.error or self.unreadable:
            raise RuntimeError(p.error or self.unreadable)
        if p.plan.sync_mode not in SYNC_MODES:
            raise ValueError(f"unknown sync mode: {p.plan.sync_mode}")
        if p.plan.sync_mode in CURSOR_MODES and not p.plan.cursor_field:
            raise ValueError(f"cursor_field is required for {p.plan.sync_mode} mode")

    def _open(self, p: _Prepared) -> None:
        """Open both ends of a table and compare them."""
        p.rows = self.source.read(p.plan.name)
        old, new = p.table.schema(), p.rows.schema
        if old is None or old == stored_schema(new):
            return
        p.changes = tuple(changed_columns(old, new, p.plan.strict_items))
        if any(c["change_type"] == TYPE_INCOMPATIBLE for c in p.changes):
            raise IncompatibleSchema(f"incompatible schema change on {p.plan.name}; the table is not loaded")

    def _event(self, p: _Prepared, event: str, **more) -> dict:
        old = p.cursor or Cursor(None, None)
        return {
            "connection": self.connection, "table_name": p.plan.name, "run_id": self.run_id, "event": event,
            "at": self.clock(), "cursor_old": old.value, "cursor_type": old.type, **more,
        }

    def _fit_schema(self, p: _Prepared) -> None:
        if p.plan.sync_mode == "full_refresh":
            return  # the new version brings the source's schema with it
        if p.table.schema() is None:
            p.table.create(p.rows.schema)
        p.table.evolve(apply_changes(p.table.schema(), p.rows.schema, p.changes))

    def _load_once(self, p: _Prepared) -> LoadResult:
        rows = self.source.read(p.plan.name) if p.rows is None else p.rows
        p.rows = None  # a retry lists the source's files anew
        if p.plan.sync_mode == "full_refresh":
            return full_refresh(rows, p.table, self.records_per_file, connection=self.connection, cursor=p.plan.cursor_field)
        return incremental_load(
            rows, p.table, p.plan.cursor_field, p.cursor, connection=self.connection, lookback=p.plan.lookback,
            delivery=self.delivery, records_per_file=self.records_per_file,
            sort_by_cursor=p.plan.sort_by_cursor, rebalance=p.plan.rebalance,
            tie_keys=p.plan.tie_keys and list(p.plan.tie_keys),
        )
