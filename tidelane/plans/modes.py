"""The three load modes: full refresh, incremental and append-only."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelane.operators.schema import align_batch
from tidelane.operators.table import SyncTable, largest
from tidelane.session import new_folder
from tidelane.sources.scan import Cursor, encode_cursor, full_scan, incremental_scan, tie_safe_scan

EXACTLY_ONCE = "exactly_once"
AT_LEAST_ONCE = "at_least_once"


@dataclass(frozen=True)
class LoadResult:
    rows: int
    cursor: Cursor | None = None
    null_cursors: int = 0
    start: Cursor | None = field(default=None, compare=False)  # where the load began


def load_id(feed: str, number: int) -> str:
    """The name of a load, fixed by its place in its feed: a retry or a re-run after a crash replaces it."""
    return f"{feed}#{number}"


def full_refresh(source: DataFrame, table: SyncTable, records_per_file: int = 0, *, connection: str = "default", cursor: str | None = None) -> LoadResult:
    """Replace the table by the source: written aside first, then published in one step.

    The copy belongs to the connection's feed. With ``cursor``, its largest cursor is measured while writing, so that the
    feed's first increment begins there without another scan.
    """
    folder, schema, written = table.stage(full_scan(source), records_per_file, cursor)
    table.swap(folder, schema, connection, cursor, written.end)
    return LoadResult(written.rows)


@dataclass(frozen=True)
class _Link:
    """Which load of a feed comes next."""

    number: int
    start: Cursor | None
    after_copy: bool = False
    ties: str | None = None


def _next_link(table: SyncTable, feed: str, cursor: str, after: Cursor | None) -> _Link:
    """The next load of a feed by the table's own records.

    ``after`` is where the last load ended, or anything else if its end was never recorded or is out of date, after a
    ledger repair for example: then the last load is repeated. The first load after the feed's full copy begins at the
    copy's largest cursor; copies of other feeds say nothing about this one.
    """
    last = table.last_load(feed)
    if last is None:
        return _Link(1, after)
    if last.copy:
        end = last.end
        if last.cursor != cursor:
            kind = table.schema()[cursor].dataType
            best = table.read_load(last).agg(encode_cursor(largest(cursor, kind), kind)).head()[0]
            end = None if best is None else Cursor(best, kind.simpleString())
        return _Link(last.number + 1, end, True)
    if after is not None and after == last.end:
        return _Link(last.number + 1, after, False, last.ties_after)
    return _Link(last.number, last.start, last.after_copy, last.ties_before)


def incremental_load(
    source: DataFrame, table: SyncTable, cursor: str, after: Cursor | None = None, *, connection: str = "default",
    lookback: Any = None, delivery: str = EXACTLY_ONCE, records_per_file: int = 0, sort_by_cursor: bool = False,
    rebalance: bool = False, tie_keys: list[str] | None = None,
) -> LoadResult:
    """Append the rows past ``after`` and return the new cursor, which never goes back and stays without rows.

    An updated row is appended as another version; ``latest_rows`` picks the last one. An ``after`` that
    contradicts what the table holds is corrected, so that no row is loaded twice; the result tells the start taken.
    ``tie_keys`` names columns that together with the cursor tell rows apart: then rows that were committed later with the
    start's own cursor value are loaded too, and those already loaded, known by digests kept with the last load, are not.
    ``delivery="at_least_once"`` begins at ``after`` whatever the table holds and keeps the rows of failed
    attempts, as plain appends do. ``rebalance`` shuffles the rows into files of even size; it is off by default,
    and worth it where a small increment comes out of a scan of many tasks.
    """
    exact = delivery == EXACTLY_ONCE
    if tie_keys and (lookback is not None or not exact):
        raise ValueError("tie_keys replaces lookback and needs exactly-once delivery")
    last = table.last_load(connection)
    link = _next_link(table, connection, cursor, after) if exact else _Link(last.number + 1 if last else 1, after)
    ties = None
    if tie_keys:
        if link.start is not None:
            # Without digests of the last load, those of the feed's copy, or else of all rows at this cursor.
            held = table.read_load(last) if last and last.copy else table.read()
            ties = link.ties or table.note_ties(held, cursor, link.start, tie_keys)
            rows = tie_safe_scan(align_batch(source, table.schema()), cursor, link.start, table.ties(ties), tie_keys)
        else:
            rows = source
    else:
        rows = incremental_scan(source, cursor, link.start, lookback)
    if link.after_copy:
        rows = rows.where(F.col(cursor).isNotNull())  # those without a cursor came with the copy
    name = load_id(connection, link.number) if exact else "r_" + uuid.uuid4().hex
    written = table.append(
        rows, name, cursor, records_per_file, rebalance, sort_by_cursor, feed=connection, number=link.number,
        start=link.start, after_copy=link.after_copy, tie_keys=tie_keys, ties_before=ties,
    )
    return LoadResult(written.rows, written.end, written.null_cursors, link.start)


# Rows are only ever added at the source: the mechanics are the same, only the promise differs.
append_only_load = incremental_load


def batch_count(rows: Column, batch_size: int) -> Column:
    """How many batches of at most ``batch_size`` rows hold ``rows`` rows."""
    return F.ceil(rows / F.lit(batch_size)).cast("bigint")


def batch_slices(df: DataFrame, batch_size: int, by: list[str]) -> DataFrame:
    """The batches each group is loaded in, as ``(batch_no, batch_rows)``.

    Only counts are needed: all batches but the last are full; ``numbered_batches`` gives the batch of every row. While writing, ``records_per_file``
    cuts the files in the same way.
    """
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    last = batch_count(F.col("n"), batch_size)
    # Numbered in two steps, so that no single array is as long as the largest group has batches.
    block = F.lit(10_000).cast("bigint")
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((last - 1) / block))
    numbers = F.sequence(F.col("_block") * block + 1, F.least(last, (F.col("_block") + 1) * block))
    # Blocks are dealt out before they are expanded, so that a group of very many batches is not one task's work.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        counted.withColumn("_block", F.explode(blocks))
        .repartition(tasks, *by, "_block")
        .withColumn("batch_no", F.explode(numbers))
        .withColumn("batch_rows", F.least(F.lit(batch_size), F.col("n") - (F.col("batch_no") - 1) * batch_size))
        .drop("n", "_block")
    )


def numbered_batches(df: DataFrame, batch_size: int, by: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """Every row with its ``row_no`` in its group, in the given order, and the ``batch_no`` of at most ``batch_size`` rows it falls in.

    Numbers come in two passes. Rows are dealt to ranges of (group, order) and written to the shared folder, so both passes see the
    same ranges; each range's rows of a group are counted, and numbered from where the ranges before it end. So a group of
    any size is spread over as many tasks as it fills ranges. Rows of equal order are told apart by their other columns; equal
    rows stay in one range, so a table that repeats one row very often should be numbered without the repeats. Null groups and
    null orders count like others, nulls first. The written rows stay in the shared folder until it is cleared.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn("_mix", F.xxhash64(*df.columns)).repartitionByRange(parts, *by, *order, "_mix")
    path = new_folder(spark, "numbered")
    ranged.withColumn("_range", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    counts = rows.groupBy("_range", *by).agg(F.count(F.lit(1)).alias("_n"))
    # A row for each range and group: a group in this window has one for each range it fills.
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_range").alias("_of"), *(F.col(c).alias(f"_by{i}") for i, c in enumerate(by)),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    within = Window.partitionBy("_range", *by).orderBy(*order, "_mix")
    same = F.col("_range") == F.col("_of")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"_by{i}"))
    number = F.col("_before") + F.row_number().over(within)
    numbered = rows.join(offsets, same).withColumn("row_no", number.cast("bigint"))
    return numbered.select(*df.columns, "row_no", batch_count(F.col("row_no"), batch_size).alias("batch_no"))
