"""Gaps between completed runs, told as a stream: timers run out when the next run of a table is overdue.

Tables share the states and timers of ``groups`` groups, since a call of a task's Python function costs milliseconds and the
runs of one table hardly anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidelane.operators.ledger import COMPLETED, KEYS
from tidelane.operators.monitor import micros
from tidelane.session import share_package

_ALERTS = "connection string, table_name string, from_us bigint, to_us bigint"
_STATE = "connection array<string>, table_name array<string>, first array<array<bigint>>, last array<array<bigint>>, told array<bigint>"
_GROUP = "_group"


def merged(stretches: list[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    """Stretches of runs, joined where no more than ``limit`` lies between them."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(stretches):
        if out and first - out[-1][1] <= limit:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def settle(stretches: list[tuple[int, int]], told: int, now: int, limit: int) -> tuple[list[tuple[int, int | None]], list[tuple[int, int]], int]:
    """What is certain once no run up to ``now`` can still arrive: gaps to tell, the stretches to keep, the end of the last told one.

    A gap is told open once ``now`` is past its limit, and again with its end once the run that ends it is certain.
    """
    alerts: list[tuple[int, int | None]] = []
    while len(stretches) > 1 and stretches[1][0] <= now:
        alerts.append((stretches[0][1], stretches[1][0]))
        stretches = stretches[1:]
    if stretches and stretches[0][1] + limit < now and told < stretches[0][1]:
        alerts.append((stretches[0][1], None))
        told = stretches[0][1]
    return alerts, stretches, told


def _watch(limit: int):
    def watch(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tables = {}
        for connection, name, first, last, told in zip(*state.get, strict=True) if state.exists else ():
            tables[connection, name] = (list(zip(first, last, strict=True)), told)
        for frame in frames:
            runs: dict[tuple, list[tuple[int, int]]] = {}
            for connection, name, us in zip(*(frame[c].tolist() for c in (*KEYS, "us")), strict=True):
                runs.setdefault((connection, name), []).append((us, us))
            for key, new in runs.items():
                stretches, told = tables.get(key, ([], -1))
                # A stretch of runs takes two numbers, however many runs it has.
                tables[key] = (merged(stretches + new, limit), told)
        now, alerts, due = state.getCurrentWatermarkMs(), [], []
        for key, (stretches, told) in tables.items():
            found, stretches, told = settle(stretches, told, now * 1000 + 999, limit)
            alerts += [(*key, a, b) for a, b in found]
            tables[key] = (stretches, told)
            # The next moment at which something becomes certain: a later stretch begins, or the first one is overdue.
            due += [a for a, _ in stretches[1:2]] or ([stretches[0][1] + limit] if stretches and told < stretches[0][1] else [])
        kept = [(*key, [a for a, _ in stretches], [b for _, b in stretches], told) for key, (stretches, told) in tables.items()]
        state.update(tuple(map(list, zip(*kept, strict=True))))
        if due:
            state.setTimeoutTimestamp(max(min(due) // 1000 + 1, now + 1))
        if alerts:
            yield pd.DataFrame(alerts, columns=["connection", "table_name", "from_us", "to_us"]).astype({"to_us": "Int64"})

    return watch


def stream_gaps(events: DataFrame, interval_seconds: int, delay: str, groups: int = 4096) -> DataFrame:
    """Alerts over a stream of ledger events: stretches of more than twice the interval without a completed run.

    Columns ``connection, table_name, gap_from, gap_to, gap_us``. An alert without ``gap_to`` comes as soon as a table is
    overdue, by event time; one with it once a run has ended the gap. Events may come in any order within ``delay``; later
    ones are dropped. Per table the state holds its stretches of runs not yet settled, which are few. The tables of a group,
    by hash one of ``groups``, are read and written together, so more groups suit very many tables of which few run in a
    batch. A checkpoint keeps the number that it began with.
    """
    limit = 2 * interval_seconds * 1_000_000
    share_package(events.sparkSession)
    done = events.where(F.col("event") == COMPLETED).select(*KEYS, micros(F.col("at")).alias("us"))
    timed = done.withColumn("_event_time", F.timestamp_micros("us")).withWatermark("_event_time", delay)
    grouped = timed.withColumn(_GROUP, F.pmod(F.xxhash64(*KEYS), F.lit(groups))).groupBy(_GROUP)
    found = grouped.applyInPandasWithState(_watch(limit), _ALERTS, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    zoneless = lambda c: (F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col(c).cast("decimal(20,0)").cast("decimal(28,6)") / F.lit(1_000_000))).cast("timestamp_ntz")
    return found.select(*KEYS, zoneless("from_us").alias("gap_from"), zoneless("to_us").alias("gap_to"), (F.col("to_us") - F.col("from_us")).alias("gap_us"))
