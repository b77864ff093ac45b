import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.operators import schema as S
from tidelane.operators.commits import ConcurrentWrite
from tidelane.operators.table import SyncTable
from tidelane.plans import modes
from tidelane.session import new_folder
from tidelane.sources.files import read_text
from tidelane.types import as_json, canonical


@pytest.fixture
def table(spark):
    return SyncTable(spark, new_folder(spark, "tables"), "t")


def ids(table):
    return sorted(r["id"] for r in table.refresh().read().select("id").collect())


def evolve(table, schema):
    table.evolve(S.apply_changes(table.schema(), schema, S.local_changes(table.schema(), schema)))


def test_absent_table(table):
    assert table.schema() is None
    with pytest.raises(LookupError):
        table.read()


def test_create_is_idempotent_and_empty(spark, table):
    table.create(T.StructType().add("id", "integer", False))
    table.create(T.StructType().add("other", "string"))
    assert table.refresh().schema() == T.StructType().add("id", "long", True)
    assert table.read().count() == 0


def test_repeated_load_replaces_itself_even_with_no_rows(spark, table):
    table.create(spark.range(0).schema)
    written = table.append(spark.range(5), "l_1", "id")
    assert written.rows == 5 and written.bytes > 100
    table.append(spark.range(3), "l_1", "id")
    table.append(spark.range(10, 12), "l_2", "id")
    assert ids(table) == [0, 1, 2, 10, 11]
    empty = table.append(spark.range(0), "l_1", "id")
    assert (empty.rows, empty.max_cursor) == (0, None)
    assert ids(table) == [10, 11]


def test_rows_of_an_attempt_before_widening_are_not_kept(spark, table):
    table.create(spark.range(0).schema)
    table.append(spark.range(4), "l_1")
    wide = spark.range(4).select(F.col("id").cast("double"))
    evolve(table, wide.schema)
    table.append(wide, "l_1")
    assert ids(table) == [0.0, 1.0, 2.0, 3.0]


def test_widening_keeps_old_rows_and_filters_reach_files(spark, table):
    table.create(T.StructType().add("id", "long").add("day", "date"))
    old = spark.sql("SELECT id, DATE '2024-01-05' AS day FROM range(3)")
    table.append(old, "l_1")
    new = spark.sql("SELECT CAST(id AS STRING) AS id, TIMESTAMP_NTZ '2024-01-06 07:00:00' AS day FROM range(3, 5)")
    evolve(table, new.schema)
    table.append(new, "l_2")
    rows = {(r["id"], r["day"]) for r in table.refresh().read().collect()}
    assert rows == {(str(i), dt.datetime(2024, 1, 5)) for i in range(3)} | {
        (str(i), dt.datetime(2024, 1, 6, 7)) for i in range(3, 5)
    }
    plan = table.read().where("id = '4'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,4)" in plan and "ReadSchema: struct<id:string>" in plan


def test_decimal_growth_keeps_every_digit(spark, table):
    table.create(T.StructType().add("n", "decimal(6,2)"))
    table.append(spark.sql("SELECT CAST(1234.56 AS DECIMAL(6,2)) AS n"), "l_1")
    finer = spark.sql("SELECT CAST(0.1234 AS DECIMAL(5,4)) AS n")
    evolve(table, finer.schema)
    table.append(finer, "l_2")
    assert sorted(r["n"] for r in table.read().collect()) == [Decimal("0.1234"), Decimal("1234.5600")]


def test_json_columns_stay_json(spark, table):
    rows = spark.range(2).select("id", F.lit('{"a": 1}').alias("doc")).select("id", as_json("doc"))
    table.create(rows.schema)
    table.append(rows, "l_1")
    assert canonical(table.refresh().read().schema["doc"]) == ("JSON", None)
    plain = T.StructType().add("id", "long").add("doc", "string")
    assert S.local_changes(table.schema(), plain) == [{"name": "doc", "change_type": S.TYPE_INCOMPATIBLE}]


def test_staged_rows_are_unseen_until_the_swap(spark, table):
    table.create(spark.range(0).schema)
    table.append(spark.range(3), "l_1")
    reader = table.read()
    folder, schema, _ = table.stage(spark.range(100, 102))
    assert ids(table) == [0, 1, 2]
    table.swap(folder, schema)
    assert ids(table) == [100, 101]
    assert reader.count() == 3  # a reader from before the swap finishes on what it began with
    table.expire_versions()
    assert ids(table) == [100, 101]


def test_a_dead_refresh_leaves_nothing_behind(spark, table):
    table.create(spark.range(0).schema)
    table.append(spark.range(3), "l_1")
    table.stage(spark.range(50))  # dies before its swap
    table.truncate()
    assert ids(table) == []
    table.append(spark.range(7, 8), "l_1")
    assert ids(table) == [7]


def test_zero_row_refresh_publishes_an_empty_table(spark, table):
    table.create(spark.range(0).schema)
    table.append(spark.range(3), "l_1")
    folder, schema, result = table.stage(spark.range(0))
    table.swap(folder, schema)
    assert (result.rows, ids(table)) == (0, [])


def test_refresh_takes_the_source_schema(spark, table):
    table.create(T.StructType().add("id", "long").add("gone", "string"))
    folder, schema, _ = table.stage(spark.range(1))
    table.swap(folder, schema)
    assert table.refresh().schema().names == ["id"]


def test_files_are_cut_at_the_batch_size(spark, table):
    table.create(spark.range(0).schema)
    table.append(spark.range(0, 1000, 1, 1), "l_1", records_per_file=300)
    assert len(table.read().inputFiles()) == 4


def test_files_can_be_sorted_by_the_cursor(spark, table):
    table.create(spark.range(0).schema)
    shuffled = spark.range(0, 1000, 1, 1).orderBy(F.xxhash64("id")).coalesce(1)
    table.append(shuffled, "l_1", "id", sort_by_cursor=True)
    assert [r["id"] for r in table.read().collect()] == list(range(1000))


def test_small_increment_of_a_wide_scan_is_one_file(spark, table):
    table.create(spark.range(0).schema)
    table.append(spark.range(0, 10_000, 1, 64).where("id % 100 = 0"), "l_1", "id", rebalance=True)
    assert len(table.read().inputFiles()) == 1


def test_a_failed_repeat_leaves_the_old_rows(spark, table):
    table.create(spark.range(0).schema)
    table.append(spark.range(5), "l")
    with pytest.raises(Exception, match="not today"):
        table.refresh().append(spark.range(5).where(F.raise_error(F.lit("not today")).isNull()), "l")
    assert ids(table) == list(range(5))


def test_nan_is_never_the_largest_cursor(spark, table):
    rows = spark.sql("SELECT * FROM VALUES (1D), (2D), (double('NaN')) AS v(c)")
    table.create(rows.schema)
    assert table.append(rows, "l", cursor="c").max_cursor.value == "2.0"


def test_bigint_widened_to_a_narrow_decimal_stays_readable(spark, table):
    big = 2**63 - 1
    table.create(T.StructType().add("n", "long"))
    table.append(spark.createDataFrame([(big,)], "n long"), "l_1")
    evolve(table, T.StructType().add("n", "decimal(5,2)"))
    table.refresh().append(spark.createDataFrame([(Decimal("123.45"),)], "n decimal(5,2)"), "l_2")
    assert sorted(r["n"] for r in table.refresh().read().collect()) == [Decimal("123.45"), Decimal(big)]
    with pytest.raises(S.IncompatibleSchema):
        S.apply_changes(T.StructType().add("n", "long"), T.StructType().add("n", "decimal(38,30)"), [{"name": "n", "change_type": S.TYPE_WIDEN}])


def test_array_items_are_never_cut(spark):
    batch = spark.createDataFrame([([1.9, 2.5],)], "a array<double>")
    with pytest.raises(S.IncompatibleSchema, match="item type"):
        S.align_batch(batch, T.StructType().add("a", T.ArrayType(T.LongType())))
    wider = S.align_batch(spark.createDataFrame([([1, 2],)], "a array<bigint>"), T.StructType().add("a", T.ArrayType(T.DoubleType())))
    assert wider.first()["a"] == [1.0, 2.0]


def test_columns_that_differ_in_case_are_refused(table):
    table.create(T.StructType().add("v", "long"))
    with pytest.raises(S.IncompatibleSchema, match="case"):
        evolve(table, T.StructType().add("V", "long"))


def test_opening_a_table_of_many_versions_takes_one_job(spark):
    root = new_folder(spark, "versions")
    table = SyncTable(spark, root, "t")
    table.create(spark.range(0).schema)
    for _ in range(19):
        table.truncate()
    context = spark.sparkContext
    context.setJobGroup("opening", "opening")
    try:
        assert SyncTable(spark, root, "t").schema() == table.schema()
        assert len(context.statusTracker().getJobIdsForGroup("opening")) <= 1
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_a_failed_repeat_leaves_the_rows_of_the_attempt_before(spark):
    table = SyncTable(spark, new_folder(spark, "repeat"), "t")
    table.create(spark.range(0).schema)
    table.append(spark.range(5), "l_1")
    with pytest.raises(Exception, match="lost"):
        table.append(spark.range(5).where("raise_error('lost') IS NULL"), "l_1")
    assert table.read().count() == 5


def test_readers_keep_their_rows_while_a_load_is_replaced(spark, table):
    table.create(spark.range(0).schema)
    table.append(spark.range(5), "l_1")
    before = table.read()
    table.append(spark.range(7), "l_1")
    assert before.count() == 5 and ids(table) == list(range(7))


def test_a_writer_that_dies_before_its_commit_changes_nothing(spark, table, monkeypatch):
    table.create(spark.range(0).schema)
    table.append(spark.range(5), "l_1")
    monkeypatch.setattr("tidelane.operators.commits.create_file", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError, match="gone"):
        table.append(spark.range(7), "l_1")
    assert ids(table) == list(range(5))


def two(spark):
    root = new_folder(spark, "writers")
    table = SyncTable(spark, root, "t")
    table.create(spark.range(0).schema)
    writers = [SyncTable(spark, root, "t") for _ in range(2)]
    for writer in writers:
        writer.schema()  # both know the table as it is now
    return table, *writers


def test_loads_of_two_writers_both_count(spark):
    table, a, b = two(spark)
    a.append(spark.range(3), "l_a", feed="a", number=1)
    b.append(spark.range(10, 12), "l_b", feed="b", number=1)
    a.append(spark.range(20, 21), "l_a2", feed="a", number=2)
    assert ids(table) == [0, 1, 2, 10, 11, 20]


def test_of_two_refreshes_one_is_refused(spark):
    table, a, b = two(spark)
    staged = [w.stage(spark.range(n)) for w, n in ((a, 10), (b, 20))]
    a.swap(*staged[0][:2])
    with pytest.raises(ConcurrentWrite):
        b.swap(*staged[1][:2])
    assert len(ids(table)) == 10


def test_writers_that_meet_in_one_feed_one_load_or_around_a_replacement_are_refused(spark):
    table, a, b = two(spark)
    a.append(spark.range(3), "f#1", feed="f", number=1)
    with pytest.raises(ConcurrentWrite):
        b.append(spark.range(3), "f#1", feed="f", number=1)
    a.schema(), b.refresh().schema()
    a.append(spark.range(1), "l")
    with pytest.raises(ConcurrentWrite):
        b.append(spark.range(1), "l")
    b.schema()
    a.truncate()
    with pytest.raises(ConcurrentWrite):
        b.append(spark.range(1), "l_9")
    b.refresh().schema()
    a.append(spark.range(2), "l_1")
    with pytest.raises(ConcurrentWrite):
        b.rewrite()
    b.refresh().schema()
    evolve(a, T.StructType().add("id", "long").add("x", "string"))
    with pytest.raises(ConcurrentWrite):
        evolve(b, T.StructType().add("id", "long").add("y", "string"))
    assert ids(table) == [0, 1]


def test_two_runs_over_one_table_never_lose_rows(spark):
    root = new_folder(spark, "writers")
    SyncTable(spark, root, "t").create(spark.range(0).schema)

    def refresh(n):
        try:
            return modes.full_refresh(spark.range(n), SyncTable(spark, root, "t")).rows
        except ConcurrentWrite:
            return None

    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(refresh, (10, 20, 30, 40)))
    told = [n for n in done if n is not None]
    assert told and SyncTable(spark, root, "t").read().count() in told


def test_opening_reads_few_commits_however_many_there_are(spark, table, monkeypatch):
    table.create(spark.range(0).schema)
    for i in range(45):
        table.append(spark.range(i, i + 1), f"l_{i}")
    read = []
    monkeypatch.setattr("tidelane.operators.commits.read_text", lambda s, p: read.append(p) or read_text(s, p))
    assert ids(table) == list(range(45)) and len(read) <= 20
    table.expire_versions()
    table.append(spark.range(45, 46), "l_45")
    assert ids(table) == list(range(46))
