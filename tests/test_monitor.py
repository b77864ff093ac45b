import datetime as dt
import random

from pyspark.sql import functions as F

from tidelane.operators import ledger as L
from tidelane.operators import monitor

T0 = dt.datetime(2024, 1, 1)


def completed(spark, times):
    rows = [{"connection": "c", "table_name": t, "run_id": "r", "event": L.COMPLETED, "at": at} for t, at in times]
    return L.event_rows(spark, rows)


def test_gaps_match_brute_force(spark):
    rng, interval = random.Random(5), 600
    times = [("a", T0 + dt.timedelta(seconds=rng.randrange(500_000))) for _ in range(600)]
    # Gaps of exactly the limit, and a microsecond more, on and off a bucket's edge.
    for start in (0, 1200, 777):
        edge = T0 + dt.timedelta(days=10 + start, seconds=start)
        times += [(f"e{start}", edge), (f"e{start}", edge + dt.timedelta(seconds=1200)),
                  (f"e{start}", edge + dt.timedelta(seconds=2400, microseconds=1))]
    wanted = set()
    for table in {t for t, _ in times}:
        at = sorted(x for t, x in times if t == table)
        wanted |= {(table, a, b) for a, b in zip(at, at[1:]) if b - a > dt.timedelta(seconds=2 * interval)}
    found = monitor.sync_gaps(completed(spark, times), interval).collect()
    assert {(r["table_name"], r["gap_from"], r["gap_to"]) for r in found} == wanted
    assert len([w for w in wanted if w[0].startswith("e")]) == 3


def test_gaps_do_not_depend_on_the_sessions_time_zone(spark):
    # The clocks of New York skip an hour at 2024-03-10 02:00.
    frame = completed(spark, [("t", dt.datetime(2024, 3, 10, 1, 30)), ("t", dt.datetime(2024, 3, 10, 3, 30))])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [r["gap_us"] for r in monitor.sync_gaps(frame, 1800).collect()] == [7_200_000_000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_overdue_is_strictly_more_than_twice_the_interval(spark):
    frame = completed(spark, [("late", T0), ("due", T0 + dt.timedelta(seconds=1))])
    now = F.lit("2024-01-01 00:20:01").cast("timestamp_ntz")
    assert [r["table_name"] for r in monitor.overdue_tables(frame, 600, now).collect()] == ["late"]


def test_all_broken_rules_are_listed_in_order(spark):
    plan = spark.sql("""
        SELECT * FROM VALUES (0, 'users', 'incremental', 'id'), (1, NULL, '', NULL), (2, 'x', 'merge', NULL),
            (3, 'y', 'append_only', ''), (4, 'z', 'full_refresh', NULL) AS p(position, name, sync_mode, cursor_field)
    """)
    found = [tuple(r) for r in monitor.validate_plan(plan).orderBy("position", "rule_no").collect()]
    assert found == [
        (1, 1, "sync.tables[1].name is required"), (1, 2, "sync.tables[1].sync_mode is required"),
        (2, 1, 'sync.tables[2].sync_mode "merge" is invalid (valid: incremental, full_refresh, append_only)'),
        (3, 1, "sync.tables[3] (y): cursor_field is required for append_only mode"),
    ]


def test_masking_keeps_other_columns(spark):
    row = monitor.mask_columns(spark.sql("SELECT 1 AS a, 'secret' AS b"), "b").head()
    assert tuple(row) == (1, "***")
