"""Compare a registered query with its SQL, run by another engine on the same files."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(map(_plain, value))
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple((type(r[i]).__name__, _plain(r[i])) for i in order) for r in rows)


# Names of result types that must agree, as both engines spell them.
_SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT", "smallint": "SMALLINT",
}


def difference(frame, con, sql: str) -> str | None:
    """What differs between a Spark result and the SQL's, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    for name, kind in frame.dtypes:
        wanted = _SQL_TYPES.get(kind, kind.upper().replace("(", "(").replace(",", ","))
        if types[name].replace(" ", "") != wanted:
            return f"type of {name}: {kind} != {types[name]}"
    want = rows_of(names, result.fetchall())
    have = rows_of(frame.columns, frame.collect())
    if want != have:
        extra, lost = list((have - want).items())[:3], list((want - have).items())[:3]
        return f"{sum(have.values())} rows, wanted {sum(want.values())}; not wanted: {extra}; missing: {lost}"
    return None
