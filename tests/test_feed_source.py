"""The connector interface on Spark's own data source API."""

from decimal import Decimal

import pytest

from tidelane.operators.jsonl import append_jsonl, read_jsonl
from tidelane.operators.table import SyncTable
from tidelane.session import new_folder
from tidelane.sources.feed_source import Files, register
from tidelane.streaming import loads

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


@pytest.fixture
def feed(spark):
    register(spark)
    path = new_folder(spark, "feed")
    return path, lambda schema: spark.read.format("tidelane_feed").schema(schema).option("path", path)


def every_type(spark):
    return spark.sql("""
        SELECT id, IF(id % 4 = 0, NULL, id) AS n, id / 3 AS x, CAST(id AS DECIMAL(30,4)) / 8 AS d, id % 2 = 0 AS b, concat('é"\n', id) AS s,
               DATE '2024-02-27' + CAST(id AS INT) AS day, TIMESTAMP '2024-03-31 00:59:59.000001 UTC' + make_interval(0, 0, 0, 0, id) AS at,
               TIMESTAMP_NTZ '2024-03-31 00:59:59.000001' + make_interval(0, 0, 0, 0, id) AS local, CAST(concat('x', id) AS BINARY) AS raw, array(id, NULL) AS list
        FROM range(40)
    """)


def test_rows_of_every_type_are_those_that_were_written(spark, feed):
    path, reader = feed
    rows = every_type(spark)
    append_jsonl(rows.where("id < 20"), path, "a")
    append_jsonl(rows.where("id >= 20").repartition(3), path, "b")
    have = reader(rows.schema).load()
    assert have.schema == rows.schema
    assert sorted(map(str, have.collect())) == sorted(map(str, rows.collect())) == sorted(map(str, read_jsonl(spark, path, rows.schema).select(rows.columns).collect()))
    assert have.rdd.getNumPartitions() == len(read_jsonl(spark, path, rows.schema).inputFiles())
    wider = reader(rows.schema.add("later", "string")).load()
    assert wider.where("later IS NULL").count() == 40
    assert spark.read.format("tidelane_feed").schema("id long").option("path", path + "-none").load().count() == 0


@pytest.mark.parametrize("where", [
    "id > 7", "n <= 9", "n IS NOT NULL AND id >= 30", "d = 1.5", "day < DATE '2024-03-05'", "local >= TIMESTAMP_NTZ '2024-03-31 01:00:09'",
    "at > TIMESTAMP '2024-03-31 01:00:09 UTC'", "b = true", "x > 5", "s > 'é'", "n IS NULL", "id IN (1, 2)", "id > 3 AND x < 9 OR b",
])
def test_filters_give_the_same_rows_pushed_or_not(spark, feed, where):
    path, reader = feed
    rows = every_type(spark)
    append_jsonl(rows, path)
    want = sorted(map(str, rows.where(where).collect()))
    for pushed in ("false", "true"):
        spark.conf.set(PUSHDOWN, pushed)
        try:
            assert sorted(map(str, reader(rows.schema).option("pushdown", pushed).load().where(where).collect())) == want
        finally:
            spark.conf.unset(PUSHDOWN)


def test_pushed_comparisons_leave_the_plan(spark, feed):
    path, reader = feed
    append_jsonl(spark.range(10), path)
    spark.conf.set(PUSHDOWN, "true")
    try:
        plan = reader("id long").option("pushdown", "true").load().where("id > 7")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(PUSHDOWN)
    assert "BatchScan tidelane_feed" in plan and "Filter (" not in plan


def test_a_file_is_read_in_batches_of_what_passes(spark, tmp_path):
    (tmp_path / "part-0").write_text("".join(f'{{"id": {i}, "d": {i}.50}}\n' for i in range(10_000)))
    (tmp_path / "_hidden").write_text("not json")
    files = Files(spark.createDataFrame([], "id long, d decimal(10,2)").schema, str(tmp_path))
    (name,) = files.names()
    assert [b.num_rows for b in files.rows(name)] == [4096, 4096, 1808]
    files.tests.append(("d", lambda a, b: a >= b, Decimal("9990")))
    assert [b["id"].to_pylist() for b in files.rows(name)] == [list(range(9990, 10_000))]


def test_a_stream_reads_each_file_once_whatever_the_order(spark, feed):
    path, _ = feed
    root = new_folder(spark, "feed-stream")
    table = SyncTable(spark, f"{root}/tables", "t")
    for load, ids in (("b", (0, 5)), ("a", (5, 9)), (None, None)):
        if load:
            append_jsonl(spark.range(*ids), path, load)
        stream = spark.readStream.format("tidelane_feed").schema("id long").option("path", path).load()
        query = loads.stream_scheduled_load(stream, table, f"{root}/checkpoint", "t", "200 milliseconds")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        assert sorted(r["id"] for r in table.read().collect()) == list(range(ids[1] if ids else 9))
