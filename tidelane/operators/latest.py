"""A table that holds the latest version of each key, kept up to date by rewriting only what a batch touches."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelane.operators.dedup import latest_rows
from tidelane.operators.schema import align_batch
from tidelane.operators.table import SyncTable

BUCKET = "bucket__"


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket of a row: keys are hashed, so a bucket holds its share of the keys whatever their rows."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge_latest(batch: DataFrame, table: SyncTable, keys: list[str], cursor: str, ties: list[str], buckets: int = 64) -> list[int]:
    """Bring a table of latest rows up to date with a batch; returns the buckets that were rewritten.

    The batch is first cut to a row a key; then only the buckets of its keys are read, merged and written, and published in one commit.
    So a batch of few keys costs a few buckets, whatever the table holds, and the same batch again changes nothing. Every
    merge of a table must name the same ``buckets``; choose as many as the table has files. Rows equal in cursor and
    ties are interchangeable, as in ``latest_rows``. Null keys are keys like others.
    """
    schema = table.refresh().schema()
    own = latest_rows(align_batch(batch, schema), keys, cursor, ties).withColumn(BUCKET, bucket_of(keys, buckets)).persist()
    try:
        # A number for each bucket at most.
        touched = sorted(r[0] for r in own.select(BUCKET).distinct().collect())
        if not touched:
            return []
        held = [table.part(f"{BUCKET}={b}") for b in touched]
        parts = [p.withColumn(BUCKET, F.lit(b)) for b, p in zip(touched, held, strict=True) if p is not None]
        both = functools.reduce(DataFrame.unionByName, parts, own).repartition(len(touched), BUCKET)
        # Dealt by bucket already, so the ranking within (bucket, keys) needs no other shuffle.
        table.replace_parts(latest_rows(both, [BUCKET, *keys], cursor, ties), BUCKET, [str(b) for b in touched])
        return touched
    finally:
        own.unpersist()
