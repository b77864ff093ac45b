import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelane.operators import ledger as L
from tidelane.operators.commits import ConcurrentWrite
from tidelane.operators.latest import merge_latest
from tidelane.operators.schema import IncompatibleSchema
from tidelane.operators.table import SyncTable
from tidelane.session import new_folder
from tidelane.streaming import gaps, loads


@pytest.fixture
def place(spark):
    root = new_folder(spark, "streams")
    return f"{root}/in", f"{root}/checkpoint", SyncTable(spark, f"{root}/tables", "t")


def arrive(rows, folder):
    rows.coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, checkpoint, table, schema):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    loads.stream_append_only(stream, table, checkpoint, "t").awaitTermination()
    return table.refresh().read()


def test_runs_resume_and_repeat_nothing(spark, place):
    folder, checkpoint, table = place
    schema = spark.range(0).schema
    for files, total in (((0, 10), 10), ((10, 15), 15), (None, 15)):
        if files:
            arrive(spark.range(*files), folder)
        rows = run(spark, folder, checkpoint, table, schema)
        assert rows.count() == rows.distinct().count() == total


def test_replayed_batch_replaces_itself(spark, place):
    folder, checkpoint, table = place
    arrive(spark.range(10), folder)
    run(spark, folder, checkpoint, table, spark.range(0).schema)
    query = spark.read.json(f"{checkpoint}/metadata").first()["id"]
    table.append(spark.range(10), f"s_t_{query}_0")  # what a replay of batch 0 does
    assert table.read().count() == 10


def test_drift_is_taken_up_on_restart(spark, place):
    folder, checkpoint, table = place
    arrive(spark.range(3), folder)
    run(spark, folder, checkpoint, table, spark.range(0).schema)
    wider = spark.range(3, 5).withColumn("note", F.lit("x"))
    arrive(wider, folder)
    rows = run(spark, folder, checkpoint, table, wider.schema)
    assert sorted((r["id"], r["note"]) for r in rows.fillna("-").collect()) == [
        (0, "-"), (1, "-"), (2, "-"), (3, "x"), (4, "x"),
    ]
    with pytest.raises(IncompatibleSchema):
        run(spark, folder, checkpoint, table, spark.range(1).select(F.col("id").cast("boolean")).schema)


def test_scheduled_load_picks_up_new_files(spark, place):
    folder, checkpoint, table = place
    arrive(spark.range(3), folder)
    query = loads.stream_scheduled_load(
        spark.readStream.schema(spark.range(0).schema).parquet(folder), table, checkpoint, "t", "200 milliseconds"
    )
    try:
        query.processAllAvailable()
        arrive(spark.range(3, 7), folder)
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r["id"] for r in table.refresh().read().collect()) == list(range(7))


def test_a_new_checkpoint_keeps_old_rows(spark, place):
    folder, checkpoint, table = place
    arrive(spark.range(5), folder)
    run(spark, folder, checkpoint, table, spark.range(0).schema)
    arrive(spark.range(5, 7), f"{folder}-2")
    rows = run(spark, f"{folder}-2", f"{checkpoint}-2", table, spark.range(0).schema)
    assert sorted(r["id"] for r in rows.collect()) == list(range(7))


def test_latest_rows_over_several_arrivals(spark, place):
    folder, checkpoint, table = place
    schema = spark.sql("SELECT 1L AS id, 1 AS version").schema
    for versions in ((1, 3), (2, 2)):
        arrive(spark.sql(f"SELECT * FROM VALUES (1L, {versions[0]}), (2L, {versions[1]}) AS v(id, version)"), folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        latest = loads.stream_latest_rows(stream, table, checkpoint, "t", ["id"], "version", [])
    assert sorted(tuple(r) for r in latest.collect()) == [(1, 2), (2, 3)]
    assert table.read().count() == 4


def test_repeats_in_later_batches_are_dropped(spark, place):
    folder, checkpoint, table = place
    rows = spark.sql("SELECT id, TIMESTAMP_NTZ '2024-01-01' + make_interval(0, 0, 0, 0, id) AS at FROM range(5)")
    for _ in range(3):
        arrive(rows, folder)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        once = loads.drop_repeats(stream, ["id"], "at", "1 day")
        loads.stream_append_only(once, table, checkpoint, "t").awaitTermination()
    assert sorted(r["id"] for r in table.refresh().read().collect()) == list(range(5))


VERSIONS = "id long, version int, note string"


def kept(spark, place, rows, buckets=16):
    folder, checkpoint, table = place
    arrive(spark.createDataFrame(rows, VERSIONS), folder)
    stream = spark.readStream.schema(VERSIONS).parquet(folder)
    loads.stream_kept_latest(stream, table, checkpoint, ["id"], "version", ["note"], buckets).awaitTermination()
    return {r["id"]: (r["version"], r["note"]) for r in table.read().collect()}


def test_kept_latest_rows_follow_arrivals_late_ones_too(spark, place):
    assert kept(spark, place, [(1, 1, "a"), (2, 3, "b"), (2, 1, "z"), (None, 1, "n")]) == {1: (1, "a"), 2: (3, "b"), None: (1, "n")}
    late = [(1, 2, "c"), (2, 2, "late"), (3, 1, "d"), (None, 2, None)]
    assert kept(spark, place, late) == {1: (2, "c"), 2: (3, "b"), 3: (1, "d"), None: (2, None)}
    assert kept(spark, place, [(1, 2, "d"), (2, None, "x")])[1] == (2, "d")  # equal cursors: the larger tie
    assert len(place[2].read().collect()) == 4


def test_a_batch_reads_and_writes_only_the_buckets_of_its_keys(spark, place):
    table = place[2]
    rows = spark.range(1000).selectExpr("id", "1 AS version", "'a' AS note")
    table.create(rows.schema)
    assert merge_latest(rows, table, ["id"], "version", [], 16) == list(range(16))
    before = set(table.read().inputFiles())
    read = []
    part, SyncTable.part = SyncTable.part, lambda self, name: read.append(name) or part(self, name)
    try:
        (bucket,) = merge_latest(spark.sql("SELECT 7L AS id, 2 AS version, 'b' AS note"), table, ["id"], "version", [], 16)
    finally:
        SyncTable.part = part
    after = set(table.read().inputFiles())
    assert read == [f"bucket__={bucket}"] and len(before & after) == len(before) - 1
    assert table.read().count() == 1000 and table.read().where("id = 7").first()["note"] == "b"
    table.expire_versions()
    assert table.read().count() == 1000
    assert merge_latest(rows.limit(0), table, ["id"], "version", [], 16) == []


def test_of_two_mergers_that_meet_one_is_refused(spark, place):
    table = place[2]
    rows = spark.range(10).selectExpr("id", "1 AS version", "'a' AS note")
    table.create(rows.schema)
    replace_parts = SyncTable.replace_parts

    def late(self, *args):
        SyncTable.replace_parts = replace_parts
        merge_latest(rows, SyncTable(spark, table.path.rsplit("/", 1)[0], "t"), ["id"], "version", [], 4)
        return replace_parts(self, *args)

    SyncTable.replace_parts = late
    try:
        with pytest.raises(ConcurrentWrite):
            merge_latest(rows, table, ["id"], "version", [], 4)
    finally:
        SyncTable.replace_parts = replace_parts
    assert table.read().count() == 10


def test_gaps_settle_as_time_passes():
    limit = 10
    assert gaps.merged([(5, 5), (1, 1), (30, 30), (12, 12), (41, 41)], limit) == [(1, 12), (30, 30), (41, 41)]
    runs = [(1, 12), (30, 30)]
    assert gaps.settle(runs, -1, 22, limit) == ([], runs, -1)  # just in time
    assert gaps.settle(runs, -1, 23, limit) == ([(12, None)], runs, 12)
    assert gaps.settle(runs, 12, 29, limit) == ([], runs, 12)
    assert gaps.settle(runs, 12, 30, limit) == ([(12, 30)], [(30, 30)], 12)
    assert gaps.settle(runs, -1, 99, limit) == ([(12, 30), (30, None)], [(30, 30)], 30)
    assert gaps.settle([], -1, 99, limit) == ([], [], -1)


def test_overdue_tables_are_told_while_the_stream_runs(spark, place):
    folder, checkpoint, table = place

    def runs(*times):
        rows = [("p", name, f"r{m}", L.COMPLETED, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)) for name, m in times]
        columns = "connection string, table_name string, run_id string, event string, at timestamp_ntz"
        arrive(spark.createDataFrame(rows, columns), folder)
        events = spark.readStream.schema(columns).parquet(folder)
        loads.stream_append_only(gaps.stream_gaps(events, 60 * 30, "10 minutes"), table, checkpoint, "t").awaitTermination()
        alerts = table.read().collect()
        minute = lambda t: t and int((t - dt.datetime(2024, 1, 1)).total_seconds() // 60)
        return sorted((r.table_name, minute(r.gap_from), minute(r.gap_to) or 0) for r in alerts)

    assert runs(("a", 0), ("b", 50), ("a", 5)) == []
    assert runs(("b", 100), ("a", 45)) == []  # late, but in time: no gap for a
    told = runs(("b", 120))
    assert told == [("a", 45, 0)]  # open: an hour has passed since
    told = runs(("a", 130), ("b", 175))
    assert told == [("a", 45, 0), ("a", 45, 130)]
    assert runs(("b", 230)) == [("a", 45, 0), ("a", 45, 130), ("a", 130, 0)]


def test_tables_share_states_of_gaps(spark, place):
    folder, checkpoint, table = place
    columns = "connection string, table_name string, run_id string, event string, at timestamp_ntz"
    start, limit = dt.datetime(2024, 1, 1), 3600
    runs = {(c, f"t{i}"): sorted({(i * 37 + k * k * 13) % 900 for k in range(9)}) for c in ("p", None) for i in range(60)}
    rows = [(*key, "r", L.COMPLETED, start + dt.timedelta(minutes=m)) for key, times in runs.items() for m in times]
    arrive(spark.createDataFrame(rows, columns), folder)
    events = spark.readStream.schema(columns).parquet(folder)
    query = loads.stream_append_only(gaps.stream_gaps(events, limit // 2, "0 seconds", groups=7), table, checkpoint, "t")
    query.awaitTermination()
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators) <= 7
    newest = max(times[-1] for times in runs.values())
    want = [(*key, a, b) for key, times in runs.items() for a, b in zip(times, times[1:], strict=False) if b - a > 60]
    want += [(*key, times[-1], None) for key, times in runs.items() if newest - times[-1] > 60]
    minute = lambda t: t and int((t - start).total_seconds() // 60)
    have = [(r.connection, r.table_name, minute(r.gap_from), minute(r.gap_to)) for r in table.read().collect()]
    ended = {x[:3] for x in have if x[3] is not None}
    assert sorted(map(str, (x for x in have if x[3] is not None or x[:3] not in ended))) == sorted(map(str, want))
