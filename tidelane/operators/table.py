"""A destination table on plain files: appended loads, schema changes and atomic publishing.

Layout under ``<root>/<name>``::

    log/<seq>.json     commits, JSON lines: an epoch's schema, a load and its folder, or a new beginning
    data/<folder>/     Parquet files of one attempt at one load
    ties/<folder>/     digests of a load's rows at its largest cursor, if it is to be tie-safe

A commit is one file that appears whole and under a number no other writer has taken. Readers see the folders that commits
name, so a repeated load keeps its old rows visible until its new ones take their place, and a full copy replaces all
others in one step. An epoch groups loads of the same column types: widening a column opens a new epoch and
costs no rewrite, because a reader casts older epochs. A feed is one chain of loads, such as those of a connection or a
stream; its loads are numbered, and only the last can come again.

Writers may meet: loads of different feeds both count; of two writers that replace the table, change its schema or add to one feed, the
later one is refused (``ConcurrentWrite``). This rests on a rename that fails if the name is taken, which HDFS and local disks
have; an object store needs a committer that gives the same. Where a catalog with table transactions is
available, its own append, alter and replace operations are the better choice.
"""

from __future__ import annotations

import functools
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.frames import empty_frame
from tidelane.operators.commits import CommitLog, ConcurrentWrite, Load, State
from tidelane.operators.schema import align_batch
from tidelane.sources.files import child_names, delete_folder, folder_bytes
from tidelane.sources.scan import Cursor, cursor_literal, encode_cursor, row_digest
from tidelane.types import stored_schema

def largest(cursor: str, kind: T.DataType) -> Column:
    """The largest cursor. NaN is above every number, so it would end all later loads; it is left out."""
    floating = isinstance(kind, (T.FloatType, T.DoubleType))
    return F.max(F.when(~F.isnan(cursor), F.col(cursor)) if floating else F.col(cursor))


@dataclass(frozen=True)
class WriteResult:
    """What one load wrote; rows and cursors are counted in the same pass as the write."""

    rows: int
    bytes: int = 0
    max_cursor: Cursor | None = None
    null_cursors: int = 0
    end: Cursor | None = None  # the larger one of ``max_cursor`` and the load's start


class SyncTable:
    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark = spark
        self.name = name
        self.path = f"{root.rstrip('/')}/{name}"
        self._log = CommitLog(spark, f"{self.path}/log")
        self._known: State | None = None

    # -- state ------------------------------------------------------------------------------------

    def _state(self) -> State | None:
        if self._known is None:
            self._known = self._log.read()
        return self._known

    def _commit(self, before: State | None, *lines: dict) -> None:
        try:
            self._known = self._log.commit(before, *lines)
        except ConcurrentWrite:
            self._known = None
            raise

    def _replace_all(self, before: State | None, epochs: dict[int, T.StructType], *loads: Load) -> None:
        began = before.seq + 1 if before else 1
        self._commit(before, *State(began, began, epochs, {x.load_id: x for x in loads}).lines())

    def refresh(self) -> SyncTable:
        """Forget what was read, to see what another writer published since."""
        self._known = None
        return self

    def schema(self) -> T.StructType | None:
        """Current schema, ``None`` when the table does not exist."""
        state = self._state()
        return state and state.schema

    def last_load(self, feed: str) -> Load | None:
        """The last load of a feed since all rows were last replaced."""
        state = self._state()
        return state and state.last(feed)

    # -- reading ----------------------------------------------------------------------------------

    def read(self) -> DataFrame:
        """All rows there are now. Filters and column choices reach the files of each epoch."""
        state = self._log.read()
        if state is None:
            raise LookupError(f"no such table: {self.name}")
        return self._read_loads(state, state.loads.values())

    def read_load(self, load: Load) -> DataFrame:
        """The rows of one load."""
        return self._read_loads(self._state(), [load])

    def _read_loads(self, state: State, loads) -> DataFrame:
        parts = []
        for epoch, schema in sorted(state.epochs.items()):
            if paths := [f"{self.path}/data/{load.folder}" for load in loads if load.epoch == epoch]:
                parts.append(align_batch(self.spark.read.schema(schema).parquet(*paths), state.schema))
        return functools.reduce(DataFrame.unionAll, parts) if parts else empty_frame(self.spark, state.schema)

    # -- schema changes ---------------------------------------------------------------------------

    def create(self, source: T.StructType) -> None:
        """Create an empty table for a source schema; an existing table is left as it is."""
        if self._state() is None:
            try:
                self._replace_all(None, {1: stored_schema(source)})
            except ConcurrentWrite:
                pass  # it exists now

    def evolve(self, schema: T.StructType) -> None:
        """Adopt the schema ``apply_changes`` gave: metadata only, in one commit."""
        state = self._state()
        if schema == state.schema:
            return
        old = {f.name: f.dataType for f in state.schema.fields}
        retyped = any(f.name in old and f.dataType != old[f.name] for f in schema.fields)
        epoch = state.epoch + 1 if retyped else state.epoch
        self._commit(state, {"epoch": epoch, "schema": schema.jsonValue()})

    # -- writing ----------------------------------------------------------------------------------

    def append(
        self, batch: DataFrame, load_id: str, cursor: str | None = None,
        records_per_file: int = 0, rebalance: bool = False, sort_by_cursor: bool = False, *,
        feed: str | None = None, number: int = 0, start: Cursor | None = None, after_copy: bool = False,
        tie_keys: list[str] | None = None, ties_before: str | None = None,
    ) -> WriteResult:
        """Add one load. The same ``load_id`` again replaces that load, also with no rows at all.

        With a ``feed``, the load is published as link ``number`` of it, so that it can be found, and repeated, even if
        the run dies before anything else is recorded. ``sort_by_cursor`` sorts within each file, without a shuffle, so that
        later filters on the cursor can skip parts of files. ``tie_keys`` keeps digests of the rows at the end.
        """
        state = self._state()
        before = state.last(feed)
        folder, done = self._write(batch, state.schema, cursor, records_per_file, rebalance, sort_by_cursor, start)
        ties = ties_before if done.end == start and not done.rows else None
        if tie_keys and done.end is not None and not ties:
            new = self.spark.read.schema(state.schema).parquet(f"{self.path}/data/{folder}")
            ties = self.note_ties(new, cursor, done.end, tie_keys, ties_before if done.end == start else None)
        load = Load(load_id, folder, state.epoch, feed, number, start, done.end, cursor, False, after_copy, ties_before, ties)
        while True:
            try:
                self._commit(state, {"load": asdict(load)})
                return done
            except ConcurrentWrite:
                known, state = state, self._state()
                same = (state.began, state.epochs, state.loads.get(load_id), state.last(feed))
                if same != (known.began, known.epochs, known.loads.get(load_id), before):
                    raise

    def _write(
        self, batch: DataFrame, schema: T.StructType, cursor: str | None = None, records_per_file: int = 0,
        rebalance: bool = False, sort_by_cursor: bool = False, start: Cursor | None = None,
    ) -> tuple[str, WriteResult]:
        """Write rows to a folder of their own, which readers see once a commit names it."""
        metrics = [F.count(F.lit(1)).alias("rows")]
        if cursor is not None:
            kind = schema[cursor].dataType
            best = largest(cursor, kind)
            metrics += [encode_cursor(best, kind).alias("max_cursor"), F.count_if(F.col(cursor).isNull()).alias("null_cursors")]
            # A source may lose its newest rows; the cursor does not go back with them.
            metrics.append((best.isNotNull() if start is None else best > cursor_literal(start).cast(kind)).alias("onward"))
        observed = Observation()
        rows = align_batch(batch, schema)
        if rebalance:
            # A small increment of a large scan would otherwise leave one tiny file per scan task.
            rows = rows.hint("rebalance")
        if sort_by_cursor:
            rows = rows.sortWithinPartitions(cursor)
        writer = rows.observe(observed, *metrics).write
        if records_per_file:
            writer = writer.option("maxRecordsPerFile", records_per_file)
        folder = uuid.uuid4().hex
        writer.parquet(f"{self.path}/data/{folder}")
        seen = observed.get
        best = seen.get("max_cursor")
        best = None if best is None else Cursor(best, schema[cursor].dataType.simpleString())
        size = folder_bytes(self.spark, f"{self.path}/data/{folder}")
        end = best if seen.get("onward") else start
        return folder, WriteResult(seen["rows"] or 0, size, best, seen.get("null_cursors") or 0, end)

    # -- ties at the cursor -----------------------------------------------------------------------

    def note_ties(self, rows: DataFrame, cursor: str, end: Cursor, keys: list[str], more: str | None = None) -> str:
        """Write digests of the rows at the cursor ``end``, and those noted as ``more``; readers do not see them."""
        digests = rows.where(F.col(cursor) == cursor_literal(end).cast(rows.schema[cursor].dataType)).select(row_digest(rows, keys))
        if more:
            digests = digests.unionAll(self.ties(more))
        name = uuid.uuid4().hex
        digests.distinct().write.parquet(f"{self.path}/ties/{name}")
        return name

    def ties(self, name: str) -> DataFrame:
        return self.spark.read.schema("digest binary").parquet(f"{self.path}/ties/{name}")

    # -- replacing --------------------------------------------------------------------------------

    def stage(self, rows: DataFrame, records_per_file: int = 0, cursor: str | None = None) -> tuple[str, T.StructType, WriteResult]:
        """Write a full copy aside, unseen by readers."""
        self._state()  # what the copy will replace
        schema = stored_schema(rows.schema)
        folder, written = self._write(rows, schema, cursor, records_per_file)
        return folder, schema, written

    def swap(self, folder: str | None, schema: T.StructType, feed: str | None = None, cursor: str | None = None, end: Cursor | None = None) -> None:
        """Publish a staged copy in place of all rows, in one atomic step; without a folder, an empty table."""
        copy = [Load("copy", folder, 1, feed, 1, None, end, cursor, True)] if folder else []
        self._replace_all(self._state(), {1: schema}, *copy)

    def replace_parts(self, rows: DataFrame, by: str, values: list[str]) -> None:
        """Replace some parts of the table by ``rows``, whose column ``by`` tells the part, in one commit.

        A part is a load named ``<by>=<value>``. ``rows`` should be dealt by that column, for a file a part. Refused if another
        writer has published anything since this table was opened.
        """
        state = self._state()
        folder = uuid.uuid4().hex
        kept = align_batch(rows, T.StructType([*state.schema.fields, rows.schema[by]]))
        kept.write.partitionBy(by).parquet(f"{self.path}/data/{folder}")
        parts = (f"{by}={value}" for value in values)
        written = set(child_names(self.spark, f"{self.path}/data/{folder}"))
        self._commit(state, *({"load": asdict(Load(p, f"{folder}/{p}", state.epoch))} for p in parts if p in written))

    def part(self, name: str) -> DataFrame | None:
        """The rows of one load or part as this table was opened, None if there is none of that name."""
        load = self._state().loads.get(name)
        return load and self.read_load(load)

    def truncate(self) -> None:
        """Remove all rows and keep the table."""
        self.swap(None, self._state().schema)

    def rewrite(self) -> WriteResult:
        """Merge loads into one, for tables that were widened or loaded many times.

        The last load of each feed stays apart as it is, since it may still come again.
        """
        state = self._state()
        last = {load.load_id for feed in {x.feed for x in state.loads.values()} if (load := state.last(feed))}
        folder, done = self._write(self._read_loads(state, [v for k, v in state.loads.items() if k not in last]), state.schema)
        self._replace_all(state, state.epochs, Load("merged", folder, state.epoch), *(v for k, v in state.loads.items() if k in last))
        return done

    def expire_versions(self) -> None:
        """Delete what no commit in use names. Run it apart from loads, once readers moved on."""
        state = self.refresh()._state()
        used = {x and x.split("/")[0] for v in state.loads.values() for x in (v.folder, v.ties_before, v.ties_after)}
        for kind in ("data", "ties"):
            for folder in child_names(self.spark, f"{self.path}/{kind}"):
                if folder not in used:
                    delete_folder(self.spark, f"{self.path}/{kind}/{folder}")
        for path in self._log.old_files(state):
            delete_folder(self.spark, path)
