"""JSON-lines destination and its size summary."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.frames import JSON_TIMES
from tidelane.functions.text import format_bytes
from tidelane.sources.files import qualified


def append_jsonl(rows: DataFrame, path: str, load_id: str | None = None) -> None:
    """Append one JSON object per row, keys sorted, NULLs written out.

    With a ``load_id`` a repeated load replaces itself instead of adding its rows again.
    """
    writer = rows.select(sorted(rows.columns)).write.options(**JSON_TIMES).option("ignoreNullFields", "false")
    writer.mode("overwrite").json(f"{path}/load_id={load_id or 'l_' + uuid.uuid4().hex}")


def read_jsonl(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).options(**JSON_TIMES, recursiveFileLookup="true").json(path)


def table_summary(spark: SparkSession, root: str) -> DataFrame:
    """Rows and size of every JSON-lines table below ``root``."""
    lines = spark.read.option("recursiveFileLookup", "true").text(root)
    # The first folder below the root names the table; sizes count each line's bytes and its end. Paths are compared
    # without their scheme, which Spark and the store write with different numbers of slashes.
    scheme = "^[A-Za-z][A-Za-z0-9+.-]*:/*"
    start = len(re.sub(scheme, "", qualified(spark, root)).strip("/"))
    below_root = F.substr(F.regexp_replace("_metadata.file_path", scheme, ""), F.lit(start + 2))
    table = F.url_decode(F.replace(F.substring_index(below_root, "/", 1), F.lit("+"), F.lit("%2B")))
    sized = lines.select(table.alias("table_name"), (F.octet_length("value") + 1).cast("bigint").alias("b"))
    return (
        sized.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"), F.sum("b").alias("bytes"))
        .withColumn("size", format_bytes(F.col("bytes")))
    )

