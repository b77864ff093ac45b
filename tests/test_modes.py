import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidelane.operators.dedup import latest_rows
from tidelane.operators.schema import apply_changes, local_changes
from tidelane.operators.table import SyncTable
from tidelane.plans import modes
from tidelane.session import new_folder
from tidelane.sources.files import write_text
from tidelane.sources.scan import Cursor, cursor_literal, incremental_scan, max_cursor, tie_safe_scan


@pytest.fixture
def table(spark):
    return SyncTable(spark, new_folder(spark, "tables"), "t")


@pytest.mark.parametrize("cursor", [Cursor("2025-04-20T10:00:00Z", "string"), Cursor("12345", "bigint")])
@pytest.mark.parametrize("load", [modes.incremental_load, modes.append_only_load])
def test_zero_rows_keep_the_cursor(spark, table, load, cursor):
    rows = spark.range(0).select(F.col("id").cast(cursor.type).alias("c"))
    table.create(rows.schema)
    assert load(rows, table, "c", cursor) == modes.LoadResult(0, cursor)


def test_full_refresh_has_no_cursor(spark, table):
    assert modes.full_refresh(spark.range(3), table) == modes.LoadResult(3, None)
    assert table.read().count() == 3


def test_rows_without_cursor_are_loaded_on_the_first_run_only(spark, table):
    rows = spark.sql("SELECT id, IF(id < 3, NULL, id) AS c FROM range(6)")
    table.create(rows.schema)
    first = modes.incremental_load(rows, table, "c")
    assert (first.rows, first.cursor, first.null_cursors) == (6, Cursor("5", "bigint"), 3)
    second = modes.incremental_load(rows, table, "c", first.cursor)
    assert (second.rows, second.cursor) == (0, first.cursor)
    assert table.read().count() == 6


def test_only_null_cursors_keep_the_start_and_are_replaced(spark, table):
    rows = spark.sql("SELECT id, CAST(NULL AS BIGINT) AS c FROM range(4)")
    table.create(rows.schema)
    for _ in range(2):
        assert modes.incremental_load(rows, table, "c").cursor is None
    assert table.read().count() == 4


@pytest.mark.parametrize("sql, rest", [
    ("CAST(9007199254740990 + id AS BIGINT)", 2),
    ("CAST(id AS DECIMAL(30,4)) / 8", 2),
    ("DATE '2024-02-27' + CAST(id AS INT)", 2),
    ("TIMESTAMP '2024-03-31 00:59:59.000001 UTC' + make_interval(0, 0, 0, 0, id)", 2),
    ("TIMESTAMP_NTZ '2024-03-31 00:59:59.000001' + make_interval(0, 0, 0, 0, id)", 2),
    ("concat('k', id)", 2),
    ("id / 3", 2),
])
def test_cursors_of_every_type_resume_exactly(spark, table, sql, rest):
    rows = spark.sql(f"SELECT id, {sql} AS c FROM range(6)")
    table.create(rows.schema)
    first = modes.incremental_load(rows.where(f"id < {6 - rest}"), table, "c")
    second = modes.incremental_load(rows, table, "c", first.cursor)
    assert (first.rows, second.rows) == (6 - rest, rest)
    assert table.read().distinct().count() == table.read().count() == 6


def test_instant_cursor_survives_a_change_of_time_zone(spark, table):
    rows = spark.sql("SELECT id, timestamp_seconds(id * 3600) AS c FROM range(6)")
    table.create(rows.schema)
    first = modes.incremental_load(rows.where("id < 4"), table, "c")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert modes.incremental_load(rows, table, "c", first.cursor).rows == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_retry_replaces_and_at_least_once_repeats(spark, table):
    rows = spark.range(10)
    table.create(rows.schema)
    modes.incremental_load(rows.where("id < 7"), table, "id")
    modes.incremental_load(rows, table, "id")
    assert table.read().count() == 10
    modes.incremental_load(rows, table, "id", delivery=modes.AT_LEAST_ONCE)
    assert table.read().count() == 20
    assert latest_rows(table.read(), ["id"], "id", []).count() == 10


def test_lookback_finds_late_rows_with_an_old_cursor(spark, table):
    rows = spark.sql("SELECT id, id AS c FROM range(10)")
    late = rows.unionAll(spark.sql("SELECT 99L AS id, 8L AS c"))
    table.create(rows.schema)
    first = modes.incremental_load(rows, table, "c")
    assert modes.incremental_load(late, table, "c", first.cursor).rows == 0
    assert modes.incremental_load(late, table, "c", first.cursor, lookback=2).rows == 3
    assert {r["id"] for r in latest_rows(table.read(), ["id"], "c", []).collect()} == {*range(10), 99}


def test_cursor_filter_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for after in (dt.datetime(2024, 1, 16), Cursor("2024-01-16 00:00:00", "timestamp_ntz")):
        plan = incremental_scan(events, "ts", after)._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan(ts,2024-01-16T00:00)" in plan


def test_cursor_values(spark):
    assert max_cursor(spark.range(0), "id", 7).head()[0] == 7
    assert max_cursor(spark.range(0), "id").head()[0] is None
    assert spark.range(1).select(cursor_literal(Decimal("1.50"))).head()[0] == Decimal("1.50")
    with pytest.raises(TypeError):
        cursor_literal(object())


def test_batches(spark):
    rows = spark.sql("SELECT IF(id < 200, 'a', 'b') AS k FROM range(251)")
    found = sorted(tuple(r) for r in modes.batch_slices(rows, 100, ["k"]).collect())
    assert found == [("a", 1, 100), ("a", 2, 100), ("b", 1, 51)]
    one_each = modes.batch_slices(spark.range(25_001).selectExpr("'a' AS k"), 1, ["k"])
    assert sorted(r["batch_no"] for r in one_each.collect()) == list(range(1, 25_002))


def test_latest_rows_of_a_hot_key_shrink_before_the_shuffle(spark):
    rows = spark.range(0, 10_000, 1, 8).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS c")
    plan = latest_rows(rows, ["k"], "c", [])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_a_cursor_that_contradicts_the_table_is_corrected(spark, table):
    table.create(spark.range(0).schema)
    first = modes.incremental_load(spark.range(4), table, "id")
    second = modes.incremental_load(spark.range(8), table, "id", first.cursor)
    for stale in (None, Cursor("1", "bigint"), first.cursor):
        assert modes.incremental_load(spark.range(9), table, "id", stale).start == first.cursor
    assert modes.incremental_load(spark.range(12), table, "id", Cursor("8", "bigint")).start == Cursor("8", "bigint")
    assert second.cursor == Cursor("7", "bigint")
    assert sorted(r["id"] for r in table.read().collect()) == list(range(12))


def test_a_commit_that_was_never_finished_is_not_seen(spark, table):
    table.create(spark.range(0).schema)
    first = modes.incremental_load(spark.range(4), table, "id")
    write_text(spark, f"{table.path}/log/_half-{3:012}.json", '{"load": ')
    assert table.refresh().last_load("default").end == first.cursor
    modes.incremental_load(spark.range(6), table, "id", first.cursor)
    assert table.refresh().last_load("default").end == Cursor("5", "bigint") and table.read().count() == 6


def test_rows_without_cursor_come_once_when_increments_follow_a_full_copy(spark, table):
    modes.full_refresh(spark.sql("SELECT id, CAST(NULL AS BIGINT) AS c FROM range(4)"), table)
    rows = spark.sql("SELECT id, IF(id < 4, NULL, id) AS c FROM range(7)")
    done = modes.incremental_load(rows, table, "c")
    assert (done.rows, table.read().count()) == (3, 7)


def test_other_feeds_and_a_truncated_table_start_where_they_say(spark, table):
    table.create(spark.range(0).schema)
    modes.incremental_load(spark.range(4), table, "id")
    assert modes.incremental_load(spark.range(3), table, "id", connection="other").rows == 3
    table.truncate()
    assert modes.incremental_load(spark.range(9), table, "id", Cursor("5", "bigint")).rows == 3


def ids(table):
    return sorted(r["id"] for r in table.refresh().read().select("id").collect())


def test_lookback_over_a_purged_source_never_moves_the_cursor_back(spark, table):
    table.create(spark.range(0).schema)
    first = modes.incremental_load(spark.range(1, 21), table, "id")
    back = modes.incremental_load(spark.range(1, 11), table, "id", first.cursor, lookback=15)
    assert (back.rows, back.cursor) == (5, Cursor("20", "bigint"))
    assert modes.incremental_load(spark.range(1, 11), table, "id", back.cursor).rows == 0
    more = modes.incremental_load(spark.range(1, 26), table, "id", back.cursor)
    assert more.rows == 5 and ids(table) == sorted([*range(1, 26), *range(6, 11)])


def test_a_copy_is_the_start_of_its_own_feed_only(spark, table):
    modes.full_refresh(spark.range(1, 11), table, connection="a", cursor="id")
    assert modes.incremental_load(spark.range(1, 101), table, "id", connection="a").rows == 90
    done = modes.incremental_load(spark.range(40, 61), table, "id", connection="b")
    assert (done.rows, done.start) == (21, None) and table.read().count() == 121


def test_the_first_increment_after_a_measured_copy_scans_nothing(spark, table, monkeypatch):
    modes.full_refresh(spark.range(1, 11), table, cursor="id")
    monkeypatch.setattr(type(table), "read_load", lambda *_: pytest.fail("scanned"))
    assert modes.incremental_load(spark.range(1, 16), table, "id").rows == 5


def test_a_repeated_load_after_a_copy_leaves_rows_without_cursor_out(spark, table):
    modes.full_refresh(spark.sql("SELECT id, CAST(NULL AS BIGINT) AS c FROM range(4)"), table)
    rows = spark.sql("SELECT id, IF(id < 4, NULL, id) AS c FROM range(7)")
    for _ in range(2):  # the ledger never learned of the first
        modes.incremental_load(rows, table, "c")
    assert ids(table) == list(range(7))


def pairs(spark, *rows):
    return spark.createDataFrame(rows, "id long, c long")


def test_late_ties_are_loaded_once(spark, table):
    table.create(pairs(spark).schema)
    rows = [(1, 5), (2, 6)]
    done = modes.incremental_load(pairs(spark, *rows), table, "c", tie_keys=["id"])
    for late in ([(3, 6)], [], [(4, 6), (5, 4)], [(6, 7)], [(7, 7), (8, 6)], []):
        rows += late
        done = modes.incremental_load(pairs(spark, *rows), table, "c", done.cursor, tie_keys=["id"])
    assert ids(table) == [1, 2, 3, 4, 6, 7]  # those behind the cursor are what lookback is for
    # The last two again, as after a crash before the ledger was written: the same rows.
    again = modes.incremental_load(pairs(spark, *rows), table, "c", None, tie_keys=["id"])
    assert again.rows == 0 and ids(table) == [1, 2, 3, 4, 6, 7]


def test_a_repeated_tie_load_excludes_what_came_before_it_only(spark, table):
    table.create(pairs(spark).schema)
    first = modes.incremental_load(pairs(spark, (1, 5)), table, "c", tie_keys=["id"])
    modes.incremental_load(pairs(spark, (1, 5), (2, 5), (3, 9)), table, "c", first.cursor, tie_keys=["id"])
    modes.incremental_load(pairs(spark, (1, 5), (2, 5), (3, 9), (4, 5)), table, "c", first.cursor, tie_keys=["id"])
    assert ids(table) == [1, 2, 3, 4]


def test_ties_after_a_copy_a_rewrite_and_a_widened_cursor(spark, table):
    modes.full_refresh(pairs(spark, (1, 5), (2, 6)), table, connection="a")
    modes.incremental_load(pairs(spark, (9, 6)), table, "c", connection="b", tie_keys=["id"])
    done = modes.incremental_load(pairs(spark, (1, 5), (2, 6), (3, 6), (9, 6)), table, "c", connection="a", tie_keys=["id"])
    assert done.rows == 2  # another feed's row 9 hides none of this feed's
    table.rewrite()
    table.expire_versions()
    rows = pairs(spark, (1, 5), (2, 6), (3, 6), (9, 6), (4, 6)).selectExpr("id", "CAST(c AS DECIMAL(20,2)) AS c")
    table.evolve(apply_changes(table.schema(), rows.schema, local_changes(table.schema(), rows.schema)))
    assert modes.incremental_load(rows, table, "c", done.cursor, connection="a", tie_keys=["id"]).rows == 1
    assert ids(table) == [1, 2, 3, 4, 9, 9]


def test_tie_keys_switched_on_later_know_the_rows_there(spark, table):
    table.create(pairs(spark).schema)
    done = modes.incremental_load(pairs(spark, (1, 5), (2, 6)), table, "c")
    done = modes.incremental_load(pairs(spark, (1, 5), (2, 6), (3, 6)), table, "c", done.cursor, tie_keys=["id"])
    assert done.rows == 1 and ids(table) == [1, 2, 3]
    with pytest.raises(ValueError, match="lookback"):
        modes.incremental_load(pairs(spark), table, "c", done.cursor, tie_keys=["id"], lookback=1)


def test_tie_filters_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    seen = spark.range(1).select(F.lit(b"x").alias("digest"))
    plan = tie_safe_scan(orders, "o_orderdate", dt.datetime(1995, 6, 17), seen, ["o_orderdate", "o_orderkey"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderdate,1995-06-17T00:00)" in text and "GreaterThan(o_orderdate,1995-06-17T00:00)" in text


def test_row_numbers_of_hot_null_tied_and_repeated_rows(spark):
    rows = spark.sql("""
        SELECT IF(id % 3 = 0, NULL, IF(id % 3 = 1, 'hot', concat('k', id % 40))) AS k, IF(id % 5 = 0, NULL, id % 17) AS o, id % 100 AS v FROM range(3000)
    """)
    found = modes.numbered_batches(rows, 100, ["k"], ["o"], 16).collect()
    assert sorted(map(str, ((r.k, r.o, r.v) for r in found))) == sorted(map(str, map(tuple, rows.collect())))
    groups = {}
    for r in found:
        groups.setdefault(r.k, []).append(r)
        assert r.batch_no == (r.row_no - 1) // 100 + 1
    for own in groups.values():
        own.sort(key=lambda r: r.row_no)
        assert [r.row_no for r in own] == list(range(1, len(own) + 1))
        order = [(r.o is not None, r.o or 0) for r in own]
        assert order == sorted(order)
    assert modes.numbered_batches(rows.limit(0), 100, ["k"], ["o"]).count() == 0


def test_a_hot_group_is_numbered_by_many_tasks(spark):
    rows = spark.range(0, 20_000, 1, 8).selectExpr("IF(id % 10 < 9, 'hot', 'cold') AS k", "id AS o")
    staged = []
    real = modes.new_folder
    modes.new_folder = lambda *args: staged.append(real(*args)) or staged[-1]
    try:
        assert modes.numbered_batches(rows, 500, ["k"], ["o"], 10).where("k = 'hot'").agg(F.max("row_no")).head()[0] == 18_000
    finally:
        modes.new_folder = real
    sizes = [r["count"] for r in spark.read.parquet(staged[0]).where("k = 'hot'").groupBy("_range").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 2 * 2000
