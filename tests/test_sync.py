import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tidelane.operators import ledger as L
from tidelane.operators.monitor import failure_report
from tidelane.operators.table import SyncTable
from tidelane.plans import inspect
from tidelane.plans import sync as sync_module
from tidelane.plans.modes import LoadResult
from tidelane.plans.sync import TablePlan, TableTimeout, results_frame, sync_tables, with_retry
from tidelane.session import new_folder
from tidelane.sources.files import child_names


class Tables:
    """A source whose tables are given as DataFrames, or as functions that make one or fail."""

    def __init__(self, **tables):
        self.tables = tables

    def table_names(self):
        return sorted(self.tables)

    def read(self, name):
        table = self.tables[name]
        return table() if callable(table) else table


class Setup:
    def __init__(self, spark):
        self.spark, self.root, self.runs = spark, new_folder(spark, "sync"), 0
        self.ledger = f"{self.root}/ledger"

    def run(self, plan, source, **options):
        self.runs += 1
        options = {"wait": lambda s: None, "run_id": f"r{self.runs}", **options}
        return sync_tables(self.spark, plan, source, f"{self.root}/tables", self.ledger, "prod", **options)

    def rows(self, name):
        return SyncTable(self.spark, f"{self.root}/tables", name).read()

    def events(self):
        rows = L.read_ledger(self.spark, self.ledger).orderBy("at").collect()
        return [(r["table_name"], r["event"]) for r in rows]


@pytest.fixture
def setup(spark):
    return Setup(spark)


ID = [TablePlan("t", "incremental", "id")]


def test_incremental_runs_advance_and_repeat_nothing(spark, setup):
    for upto, rows in ((5, 5), (5, 0), (8, 3)):
        (result,) = setup.run(ID, Tables(t=spark.range(upto)))
        assert (result.success, result.rows) == (True, rows)
    assert sorted(r["id"] for r in setup.rows("t").collect()) == list(range(8))
    assert L.safe_cursor(L.read_ledger(spark, setup.ledger)).head()["cursor_value"] == "7"


def test_crash_between_write_and_ledger_repeats_no_row(spark, setup, monkeypatch):
    setup.run(ID, Tables(t=spark.range(5)))
    real = L.append_lines

    def dies(spark, path, events):
        if "completed" in {r["event"] for r in events}:
            raise KeyboardInterrupt
        real(spark, path, events)

    with monkeypatch.context() as patched:
        patched.setattr(L, "append_lines", dies)
        with pytest.raises(KeyboardInterrupt):
            setup.run(ID, Tables(t=spark.range(9)))
    assert L.needs_resume(L.read_ledger(spark, setup.ledger)).head()["needs_resume"] is True
    (result,) = setup.run(ID, Tables(t=spark.range(12)))
    assert result.rows == 7
    assert sorted(r["id"] for r in setup.rows("t").collect()) == list(range(12))


def test_one_failure_leaves_other_tables_alone(spark, setup):
    def broken():
        raise ConnectionError("dial db://u:secret@host/x failed")

    plan = [TablePlan("a", "full_refresh"), TablePlan("b", "full_refresh"), TablePlan("c", "append_only")]
    results = setup.run(plan, Tables(a=spark.range(3), b=broken, c=spark.range(2)))
    assert [(r.table_name, r.success, r.rows) for r in results] == [("a", True, 3), ("b", False, 0), ("c", False, 0)]
    assert results[2].error == "cursor_field is required for append_only mode"
    report = {r["table_name"]: r["report"] for r in failure_report(results_frame(spark, "r1", results)).collect()}
    assert "secret" not in report["b"] and "[REDACTED] failed" in report["b"]
    assert report[None] == "Total failed tables: 2"


def test_incompatible_drift_halts_only_its_table(spark, setup):
    plan = [TablePlan("t", "incremental", "id"), TablePlan("u", "full_refresh"), TablePlan("v", "incremental", "id")]
    def tables(n, cast):
        changed = spark.range(n).select("id", F.lit("1").cast(cast).alias("x"))
        return Tables(t=changed, u=changed, v=spark.range(n))

    setup.run(plan, tables(3, "string"))
    halted = setup.run(plan, tables(6, "int"))
    assert [r.success for r in halted] == [False, False, True]
    assert "incompatible schema" in halted[0].error
    assert setup.rows("t").count() == 3 and setup.rows("u").count() == 3 and setup.rows("v").count() == 6
    assert ("t", "started") not in setup.events()[len(plan) * 2:]
    healed = setup.run(plan, tables(6, "string"))
    assert [r.success for r in healed] == [True] * 3 and setup.rows("t").count() == 6


def test_compatible_drift_is_applied_before_loading(spark, setup):
    setup.run(ID, Tables(t=spark.sql("SELECT id, 1 AS n, 'x' AS gone FROM range(2)")))
    (result,) = setup.run(ID, Tables(t=spark.sql("SELECT id, 2.5D AS n, true AS new FROM range(4)")))
    assert {(c["name"], c["change_type"]) for c in result.changes} == {
        ("n", "type_widen"), ("gone", "remove_column"), ("new", "add_column"),
    }
    assert {tuple(r) for r in setup.rows("t").collect()} == {
        (0, 1.0, "x", None), (1, 1.0, "x", None), (2, 2.5, None, True), (3, 2.5, None, True),
    }


def test_starts_are_recorded_before_reading(spark, setup):
    @F.udf("long")
    def dies(i):
        raise ValueError("permission denied")

    (result,) = setup.run(ID, Tables(t=spark.range(3).select(dies("id").alias("id"))))
    assert not result.success and result.error.startswith("fatal, not tried again")
    assert setup.events() == [("t", "started"), ("t", "failed")]


def test_full_refresh_keeps_an_earlier_cursor(spark, setup):
    setup.run(ID, Tables(t=spark.range(5)))
    setup.run([TablePlan("t", "full_refresh")], Tables(t=spark.range(5)))
    assert L.safe_cursor(L.read_ledger(spark, setup.ledger)).head()["cursor_value"] == "4"


def test_renamed_destination_and_plan_as_data(spark, setup):
    plan = spark.sql("SELECT 't' AS name, 'full_refresh' AS sync_mode, NULL AS cursor_field, "
                     "'dim_t' AS destination_table, 0 AS timeout_minutes")
    assert setup.run(plan, Tables(t=spark.range(2)))[0].success
    assert setup.rows("dim_t").count() == 2


def test_deadline_cancels_the_running_job(spark, setup):
    @F.udf("long")
    def slow(i):
        time.sleep(60)
        return i

    plan = [TablePlan("t", "full_refresh", timeout_minutes=3 / 60), TablePlan("u", "full_refresh")]
    begun = time.monotonic()
    slow_one, other = setup.run(plan, Tables(t=spark.range(1).select(slow("id").alias("id")), u=spark.range(2)))
    assert time.monotonic() - begun < 40
    assert (slow_one.success, slow_one.error, other.success) == (False, "deadline exceeded after 3 s", True)


def test_retry_waits_twice_as_long_each_time():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError("connection reset")
        return LoadResult(1)

    assert with_retry(flaky, wait=waits.append) == LoadResult(1)
    assert waits == [1, 2]


@pytest.mark.parametrize("error, calls_made, message", [
    (ConnectionError("no route"), 3, "gave up after 3 attempts: no route"),
    (RuntimeError("Access Denied"), 1, "fatal, not tried again: Access Denied"),
])
def test_retry_gives_up(error, calls_made, message):
    calls = []

    def fails():
        calls.append(1)
        raise error

    with pytest.raises(RuntimeError, match=message):
        with_retry(fails, wait=lambda s: None)
    assert len(calls) == calls_made


def test_deadline_is_never_retried():
    calls = []

    def late():
        calls.append(1)
        raise TableTimeout("deadline exceeded")

    with pytest.raises(TableTimeout):
        with_retry(late, wait=lambda s: None)
    assert len(calls) == 1


def test_a_destination_is_written_by_one_table_of_a_plan(spark, setup):
    plan = [TablePlan("t", "full_refresh"), TablePlan("u", "full_refresh", destination_table="t")]
    first, second = setup.run(plan, Tables(t=spark.range(3), u=spark.range(5)))
    assert (first.success, second.success, second.error) == (True, False, "destination t is planned twice")
    assert setup.rows("t").count() == 3


def test_looking_at_a_plan_moves_nothing(spark, setup):
    plan = [TablePlan("t", "incremental", "id"), TablePlan("u", "full_refresh", destination_table="dim_u")]
    setup.run(plan, Tables(t=spark.range(2), u=spark.range(2)))
    source = Tables(t=spark.sql("SELECT id, array('x') AS tags FROM range(4)"), u=spark.sql("SELECT true AS id"))
    lines = {(r["name"], r["destination"], r["line"]) for r in inspect.dry_run(spark, plan, source).collect()}
    assert lines == {
        ("t", "t", "- id                   INT64"), ("t", "t", "- tags                 REPEATED [items: STRING]"),
        ("u", "dim_u", "- id                   BOOL"),
    }
    changes = inspect.pending_changes(spark, plan, source, f"{setup.root}/tables").collect()
    assert {(c["table_name"], c["name"], c["change_type"]) for c in changes} == {
        ("t", "tags", "add_column"), ("dim_u", "id", "type_incompatible"),
    }
    assert setup.rows("t").count() == 2


def test_validation_lists_every_problem(spark):
    plan = [TablePlan("t", "incremental"), TablePlan("lost", "full_refresh"), TablePlan("u", "merge")]
    found = inspect.validate(spark, plan, Tables(t=None, u=None)).collect()
    assert {tuple(r) for r in found} == {
        ("t", "sync.tables[0] (t): cursor_field is required for incremental mode"),
        ("lost", "not found in source"),
        ("u", 'sync.tables[2].sync_mode "merge" is invalid (valid: incremental, full_refresh, append_only)'),
    }


def test_clock_is_the_callers(spark, setup):
    setup.run(ID, Tables(t=spark.range(1)), clock=lambda: dt.datetime(2020, 1, 1, 0, 0, 0, 5))
    assert {r["at"] for r in L.read_ledger(spark, setup.ledger).collect()} == {dt.datetime(2020, 1, 1, 0, 0, 0, 5)}
    assert sync_module.utc_now().tzinfo is None


class _Flaky:
    """A source whose first read of a table fails when it runs, as one does whose files have changed."""

    def __init__(self, spark):
        self.spark, self.reads = spark, 0

    def read(self, name):
        self.reads += 1
        rows = self.spark.range(3)
        return rows.where("raise_error('files changed') IS NULL") if self.reads == 1 else rows


def _sync(spark, source, ledger):
    root = new_folder(spark, "flaky")
    plan = [TablePlan("a", "full_refresh")]
    return sync_tables(spark, plan, source, f"{root}/tables", ledger or f"{root}/ledger", "c", wait=lambda s: None)


def test_a_retry_reads_the_source_anew(spark):
    source = _Flaky(spark)
    (result,) = _sync(spark, source, None)
    assert result.success and result.rows == 3 and source.reads == 2


def test_a_failing_ledger_write_keeps_the_results(spark, monkeypatch):
    append, calls = L.append_lines, []

    def fail_at_ends(spark, folder, events):
        calls.append(1)
        if len(calls) > 1:
            raise OSError("disk full")
        append(spark, folder, events)

    monkeypatch.setattr(L, "append_lines", fail_at_ends)
    (result,) = _sync(spark, _Flaky(spark), None)
    assert not result.success and "disk full" in result.error


def test_a_plan_with_more_columns_is_taken(spark):
    root = new_folder(spark, "plan")
    plan = spark.createDataFrame([(1, "a", "full_refresh")], "position int, name string, sync_mode string")
    source = _Flaky(spark)
    source.reads = 1
    (result,) = sync_tables(spark, plan, source, f"{root}/tables", f"{root}/ledger", "c")
    assert result.success


def test_a_source_that_never_answers_holds_up_no_other_table(spark, setup):
    def stuck():
        time.sleep(60)

    plan = [TablePlan("a", "full_refresh", timeout_minutes=1 / 60), TablePlan("b", "full_refresh")]
    begun = time.monotonic()
    late, other = setup.run(plan, Tables(a=stuck, b=lambda: spark.range(3)))
    assert time.monotonic() - begun < 40
    assert (late.success, late.error, other.success, other.rows) == (False, "deadline exceeded after 1 s", True, 3)


def test_a_ledger_that_cannot_be_read_fails_each_table(spark, setup):
    setup.run(ID, Tables(t=spark.range(3)))
    spark.range(1).select(F.lit("{torn").alias("value")).write.text(f"{setup.ledger}/torn")
    plan = [*ID, TablePlan("u", "full_refresh")]
    results = setup.run(plan, Tables(t=spark.range(5), u=spark.range(2)))
    assert [(r.table_name, r.success) for r in results] == [("t", False), ("u", False)]
    assert all(r.error.startswith("the ledger cannot be read") for r in results)
    assert setup.rows("t").count() == 3


def test_durations_leave_out_the_wait_for_a_worker(spark, setup):
    def slow():
        time.sleep(3)
        return spark.range(1)

    plan = [TablePlan("a", "full_refresh"), TablePlan("b", "full_refresh")]
    first, second = setup.run(plan, Tables(a=slow, b=spark.range(1)), parallel_tables=1)
    assert first.duration_us >= 3_000_000 > second.duration_us


def test_table_options_reach_the_load(spark, setup):
    plan = [TablePlan("t", "incremental", "id", lookback=2, sort_by_cursor=True, rebalance=True)]
    setup.run(plan, Tables(t=spark.range(5)))
    assert setup.run(plan, Tables(t=spark.range(6)))[0].rows == 3
    strict = [TablePlan("u", "incremental", "id", strict_items=True)]
    setup.run(strict, Tables(u=spark.sql("SELECT id, array(id) AS x FROM range(2)")))
    (refused,) = setup.run(strict, Tables(u=spark.sql("SELECT id, array('a') AS x FROM range(4)")))
    assert not refused.success and "incompatible schema" in refused.error


def test_a_plan_frame_can_be_run(spark, setup):
    (result,) = setup.run(inspect.plan_frame(spark, ID), Tables(t=spark.range(4)))
    assert result.success and result.rows == 4


def test_a_long_ledger_is_compacted_before_a_run(spark, setup):
    for upto in (2, 4, 6):
        setup.run(ID, Tables(t=spark.range(upto)))
    before = {tuple(r) for r in L.read_ledger(spark, setup.ledger).collect()}
    setup.run(ID, Tables(t=spark.range(7)), compact_ledger_above=4)
    assert len(child_names(spark, setup.ledger)) == 3  # the compacted events, one start and one end
    assert before < {tuple(r) for r in L.read_ledger(spark, setup.ledger).collect()}
    assert sorted(r["id"] for r in setup.rows("t").collect()) == list(range(7))


def test_a_run_over_many_tables_leaves_few_ledger_files(spark, setup):
    plan = [TablePlan(f"t{i}", "full_refresh") for i in range(100)]

    class Same:
        def read(self, name):
            if name == "t7":
                raise ValueError("no such table")
            return spark.range(1)

    results = setup.run(plan, Same())
    assert sum(r.success for r in results) == 99
    assert L.read_ledger(spark, setup.ledger).count() == 199  # a table that cannot be opened has not begun
    assert len(child_names(spark, setup.ledger)) < 125


def test_a_run_over_a_long_ledger_takes_a_snapshot_and_reads_no_old_file(spark, setup):
    for upto in (2, 4, 6):
        setup.run(ID, Tables(t=spark.range(upto)))
    setup.run(ID, Tables(t=spark.range(7)), snapshot_ledger_above=4)
    assert len(L.unfolded(spark, setup.ledger)) == 2
    assert len(L.read_recent(spark, setup.ledger).inputFiles()) == 3
    setup.run(ID, Tables(t=spark.range(9)))
    assert sorted(r["id"] for r in setup.rows("t").collect()) == list(range(9))
