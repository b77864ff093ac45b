"""A connector as a Spark data source: partitions, pushed filters and stream offsets, over the JSON-lines layout.

``JsonLinesFeed`` reads what ``append_jsonl`` writes. Connectors to other systems follow the same pattern, and once registered are
read as any format is::

    register(spark)
    spark.read.format("tidelane_feed").schema(schema).option("path", path).load().where("id > 7")
    spark.readStream.format("tidelane_feed").schema(schema).option("path", path).load()

Each file is a partition. Comparisons of a column with a value are tested in the task that reads the file, before rows
reach Spark, with the option ``pushdown`` in sessions that set ``spark.sql.python.filterPushdown.enabled``. A stream's offset names the files it has read, so files
may appear in any order.
"""

from __future__ import annotations

import base64
import datetime as dt
import io
import json
import operator
from collections.abc import Callable, Iterator
from decimal import Decimal

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition,
    IsNotNull, LessThan, LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_type

from tidelane.session import share_package

_COMPARISONS: dict[type, Callable] = {
    EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le,
}
#: Types that Python and Spark order alike; NaN keeps floating point out.
_PUSHED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
ROWS_A_BATCH = 4096


def _parser(kind: T.DataType) -> Callable:
    """How a JSON value becomes a value of a column; the inverse of Spark's JSON writer."""
    if isinstance(kind, T.TimestampNTZType):
        return dt.datetime.fromisoformat
    if isinstance(kind, T.TimestampType):
        return lambda v: dt.datetime.fromisoformat(v).astimezone(dt.timezone.utc)
    if isinstance(kind, T.DateType):
        return dt.date.fromisoformat
    if isinstance(kind, T.DecimalType):
        return lambda v: Decimal(str(v))
    if isinstance(kind, T.BinaryType):
        return base64.b64decode
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float
    if isinstance(kind, T.ArrayType):
        item = _parser(kind.elementType)
        return lambda v: [None if x is None else item(x) for x in v]
    return lambda v: v


class FilePartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


class Files:
    """The files below a path, and how the rows of one are read; tasks get a copy of it."""

    def __init__(self, schema: T.StructType, path: str):
        self.path, self.schema = path, schema
        self.tests: list[tuple[str, Callable, object]] = []

    def _store(self) -> tuple[pafs.FileSystem, str]:
        has_scheme = "://" in self.path or self.path.startswith("file:")
        return pafs.FileSystem.from_uri(self.path) if has_scheme else (pafs.LocalFileSystem(), self.path)

    def names(self) -> list[str]:
        store, folder = self._store()
        found = store.get_file_info(pafs.FileSelector(folder, recursive=True, allow_not_found=True))
        # Names with a leading dot or underscore are not data, as everywhere in Spark.
        hidden = lambda p: any(x.startswith((".", "_")) for x in p[len(folder) :].split("/"))
        return sorted(f.path for f in found if f.type == pafs.FileType.File and not hidden(f.path))

    def rows(self, name: str) -> Iterator[pa.RecordBatch]:
        parsers = [(f.name, _parser(f.dataType)) for f in self.schema.fields]
        target = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in self.schema.fields])
        made: list[dict] = []
        with self._store()[0].open_input_stream(name) as stream:
            for line in io.TextIOWrapper(stream, "utf-8", newline="\n"):
                raw = json.loads(line, parse_float=Decimal)
                row = {c: None if raw.get(c) is None else parse(raw[c]) for c, parse in parsers}
                if all(row[c] is not None and test(row[c], value) for c, test, value in self.tests):
                    made.append(row)
                if len(made) == ROWS_A_BATCH:
                    yield pa.RecordBatch.from_pylist(made, target)
                    made = []
        if made:
            yield pa.RecordBatch.from_pylist(made, target)


class _Reader(DataSourceReader):
    def __init__(self, files: Files):
        self.files = files

    def partitions(self) -> list[InputPartition]:
        return [FilePartition(n) for n in self.files.names()]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        # A table without files still has one empty partition.
        return self.files.rows(partition.path) if partition is not None else iter(())


class _FilteringReader(_Reader):
    """Spark refuses a reader that takes filters unless the session allows it, so this one is apart."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take comparisons of top-level columns; leave the others to Spark."""
        kinds = {f.name: f.dataType for f in self.files.schema.fields}
        for one in filters:
            column = one.attribute[0] if hasattr(one, "attribute") and len(one.attribute) == 1 else None
            if isinstance(one, IsNotNull) and column in kinds:
                self.files.tests.append((column, lambda value, _: True, None))
            elif type(one) in _COMPARISONS and column in kinds and isinstance(kinds[column], _PUSHED):
                value = one.value
                if isinstance(value, dt.datetime) and isinstance(kinds[column], T.TimestampType):
                    value = value.astimezone(dt.timezone.utc)
                self.files.tests.append((column, _COMPARISONS[type(one)], value))
            else:
                yield one


class _StreamReader(DataSourceStreamReader):
    def __init__(self, files: Files):
        self.files = files

    def initialOffset(self) -> dict:
        return {"read": []}

    def latestOffset(self) -> dict:
        return {"read": self.files.names()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [FilePartition(n) for n in sorted(set(end["read"]) - set(start["read"]))]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        return self.files.rows(partition.path)

    def commit(self, end: dict) -> None:
        pass  # files stay where they are

    def stop(self) -> None:
        pass


class JsonLinesFeed(DataSource):
    """Options: ``path``, the folder of a JSON-lines table, and ``pushdown`` (false). The schema is the reader's; keys that a line lacks are NULL."""

    @classmethod
    def name(cls) -> str:
        return "tidelane_feed"

    def schema(self) -> str:
        raise ValueError("give the schema: spark.read.format(...).schema(...)")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        pushed = self.options.get("pushdown", "false").lower() == "true"
        return (_FilteringReader if pushed else _Reader)(Files(schema, self.options["path"]))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _StreamReader(Files(schema, self.options["path"]))


def register(spark: SparkSession) -> None:
    """Make the connector known to a session as ``tidelane_feed``."""
    share_package(spark)
    spark.dataSource.register(JsonLinesFeed)
