"""Structured Streaming loads: the checkpoint plays the part the cursor plays in batch loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelane.operators.dedup import latest_rows
from tidelane.operators.latest import merge_latest
from tidelane.operators.schema import apply_changes, local_changes
from tidelane.operators.table import SyncTable


def _start(stream: DataFrame, table: SyncTable, checkpoint: str, name: str, **trigger) -> StreamingQuery:
    if table.schema() is None:
        table.create(stream.schema)
    # A stream's columns are fixed while it runs. After drift, stop it and start it again with the same
    # checkpoint: the new columns are taken up here, an incompatible one is refused.
    table.evolve(apply_changes(table.schema(), stream.schema, local_changes(table.schema(), stream.schema)))

    query: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        # Each batch has a folder of its own, so a batch that is replayed after a crash replaces itself. Batch numbers
        # begin anew with a new checkpoint, so the folder is also named after the query that the checkpoint belongs to.
        if not query:
            query.append(batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"])
        target = SyncTable(batch.sparkSession, table.path.rsplit("/", 1)[0], table.name)
        feed = f"s_{name}_{query[0]}"
        target.append(batch, f"{feed}_{batch_id}", feed=feed, number=batch_id)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def stream_append_only(stream: DataFrame, table: SyncTable, checkpoint: str, name: str) -> StreamingQuery:
    """Append what arrived since the last run, then stop. Runs resume from the checkpoint."""
    return _start(stream, table, checkpoint, name, availableNow=True)


def stream_scheduled_load(
    stream: DataFrame, table: SyncTable, checkpoint: str, name: str, interval: str
) -> StreamingQuery:
    """The same on an interval, until stopped. A slow round delays the next one; rounds never overlap."""
    return _start(stream, table, checkpoint, name, processingTime=interval)


def drop_repeats(stream: DataFrame, keys: list[str], cursor: str, delay: str) -> DataFrame:
    """Drop exact repeats of a delivery that arrive within ``delay`` of each other.

    ``cursor`` must be a time. The first arrival is kept; state is held for ``delay`` only, so it must
    cover how late rows may come.
    """
    timed = stream.withColumn("_event_time", F.col(cursor).cast("timestamp")).withWatermark("_event_time", delay)
    return timed.dropDuplicatesWithinWatermark([*keys, cursor]).drop("_event_time")


def stream_kept_latest(
    stream: DataFrame, table: SyncTable, checkpoint: str, keys: list[str], cursor: str, ties: list[str], buckets: int = 64,
    **trigger,
) -> StreamingQuery:
    """Keep a table at the latest version of every key, each micro-batch rewriting only the buckets of its keys.

    The table holds nothing but latest rows; ``stream_latest_rows`` keeps all versions instead. A replayed batch changes nothing.
    The default trigger takes in what arrived and stops; ``processingTime`` keeps it running.
    """
    if table.schema() is None:
        table.create(stream.schema)
    table.evolve(apply_changes(table.schema(), stream.schema, local_changes(table.schema(), stream.schema)))

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_latest(batch, SyncTable(batch.sparkSession, table.path.rsplit("/", 1)[0], table.name), keys, cursor, ties, buckets)

    how = trigger or {"availableNow": True}
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**how).start()


def stream_latest_rows(
    stream: DataFrame, table: SyncTable, checkpoint: str, name: str, keys: list[str], cursor: str, ties: list[str]
) -> DataFrame:
    """Take in what arrived and give the latest version of every key over all that was ever appended.

    All versions are kept, so this ranks the whole table; ``stream_kept_latest`` keeps the latest ones only.
    """
    stream_append_only(stream, table, checkpoint, name).awaitTermination()
    return latest_rows(table.refresh().read(), keys, cursor, ties)
