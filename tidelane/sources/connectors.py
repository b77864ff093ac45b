"""Sources that tables are synced from: any Spark file format, a catalog database, or JDBC.

A connector offers ``table_names()`` and ``read(name)``; anything else with these two methods, such
as a wrapper around a Python data source, works as well.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.functions.typemap import map_source_types
from tidelane.sources.files import child_names
from tidelane.types import as_json


class Source(Protocol):
    def table_names(self) -> list[str]: ...

    def read(self, name: str) -> DataFrame: ...


@dataclass(frozen=True)
class FileSource:
    """One file or folder per table under ``root``, for example ``<root>/orders.parquet``."""

    spark: SparkSession
    root: str
    format: str = "parquet"
    suffix: str = ".parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def table_names(self) -> list[str]:
        names = child_names(self.spark, self.root)
        return [n.removesuffix(self.suffix) for n in names if n.endswith(self.suffix)]

    def read(self, name: str) -> DataFrame:
        return self.spark.read.format(self.format).options(**self.options).load(f"{self.root}/{name}{self.suffix}")


@dataclass(frozen=True)
class CatalogSource:
    """The tables, but not the views, of one catalog database."""

    spark: SparkSession
    database: str = "default"

    def table_names(self) -> list[str]:
        tables = self.spark.catalog.listTables(self.database)
        return sorted(t.name for t in tables if t.tableType in ("MANAGED", "EXTERNAL"))

    def read(self, name: str) -> DataFrame:
        return self.spark.table(f"`{self.database}`.`{name}`")


@dataclass(frozen=True)
class Split:
    """How a JDBC table is divided into parallel reads."""

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class JdbcSource:
    """Tables of one schema of a relational database.

    Cursor filters and column choices are pushed into the database. A table named in ``splits`` is
    read over several connections at once, by even steps (``Split``) or by the conditions that ``split_conditions`` takes
    from rows at hand; others take one. With ``typed``, which is for PostgreSQL, columns keep the
    canonical types of the database's own catalog; Spark's reader alone gives JSON columns as plain strings.
    """

    spark: SparkSession
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    schema: str = "public"
    fetch_size: int = 10_000
    splits: Mapping[str, Split | Sequence[str]] = field(default_factory=dict)
    typed: bool = False

    def catalog_options(self) -> dict[str, str]:
        schema = self.schema.replace("'", "''")
        query = (
            "(SELECT table_name FROM information_schema.tables "
            f"WHERE table_schema = '{schema}' AND table_type = 'BASE TABLE') t"
        )
        return {**self.properties, "url": self.url, "dbtable": query}

    def table_options(self, name: str) -> dict[str, str]:
        schema, table = (x.replace('"', '""') for x in (self.schema, name))
        options = {
            **self.properties, "url": self.url, "dbtable": f'"{schema}"."{table}"',
            "fetchsize": str(self.fetch_size),
        }
        split = self.splits.get(name)
        if isinstance(split, Split):
            options |= {
                "partitionColumn": split.column, "lowerBound": split.lower,
                "upperBound": split.upper, "numPartitions": str(split.partitions),
            }
        return options

    def type_options(self, name: str) -> dict[str, str]:
        quoted = ".".join('"' + x.replace('"', '""') + '"' for x in (self.schema, name)).replace("'", "''")
        query = (
            "(SELECT attname AS name, CAST(atttypid AS bigint) AS type_oid FROM pg_attribute "
            f"WHERE attrelid = to_regclass('{quoted}') AND attnum > 0 AND NOT attisdropped) t"
        )
        return {**self.properties, "url": self.url, "dbtable": query}

    def table_names(self) -> list[str]:
        return sorted(r[0] for r in self._load(self.catalog_options()).collect())

    def read(self, name: str) -> DataFrame:
        options = self.table_options(name)
        split = self.splits.get(name)
        if split and not isinstance(split, Split):
            own = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
            rows = self.spark.read.jdbc(self.url, options["dbtable"], predicates=list(split), properties=own)
        else:
            rows = self._load(options)
        return with_source_types(rows, self._load(self.type_options(name))) if self.typed else rows

    def _load(self, options: Mapping[str, str]) -> DataFrame:
        return self.spark.read.format("jdbc").options(**options).load()


def _sql_literal(value) -> str:
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.replace(tzinfo=None).isoformat(' ')}'"
    return f"DATE '{value.isoformat()}'" if isinstance(value, dt.date) else str(value)


def split_conditions(rows: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list[str]:
    """SQL conditions that divide a table into ranges of about equally many rows, for parallel reads.

    Bounds are the quantiles of ``rows``: the table itself, a sample, or what was copied from it last time. Whatever they
    are, each row meets exactly one condition: the first and the last range are open, NULLs have a condition of their own,
    and so has a value that fills a range by itself. ``column`` is a number, date or timestamp without time zone. Only the bounds, at most
    ``parts`` of them, come to the driver.
    """
    wanted = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx(column, wanted, accuracy)).head()[0] if wanted else []
    bounds = [b for b in found or () if b == b]  # NaN is above all numbers, so it falls in the last range
    name = '"' + column.replace('"', '""') + '"' if not column.isidentifier() else column
    # A bound that comes twice is a value of more rows than a range should have.
    repeated = {b for b, n in Counter(bounds).items() if n > 1}
    # Pairs (value, inclusive): a range begins after the one before it and ends here.
    edges: list[tuple[object, bool]] = []
    for bound in sorted(set(bounds)):
        edges += [(bound, False), (bound, True)] if bound in repeated else [(bound, False)]
    conditions, low = [], None
    for value, inclusive in edges:
        upper = f"{name} {'<=' if inclusive else '<'} {_sql_literal(value)}"
        conditions.append(upper if low is None else f"{low} AND {upper}")
        low = f"{name} {'>' if inclusive else '>='} {_sql_literal(value)}"
    return [*conditions, low or f"{name} IS NOT NULL", f"{name} IS NULL"]


def with_source_types(rows: DataFrame, columns: DataFrame) -> DataFrame:
    """Tag the JSON columns of a table, from the ``(name, type_oid)`` of its columns."""
    known = map_source_types(columns).where("type = 'JSON'").select("name").collect()
    tagged = {r["name"] for r in known}
    return rows.select([
        as_json(f"`{f.name}`", f.name) if f.name in tagged and isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in rows.schema.fields
    ])
