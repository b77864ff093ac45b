"""Small Spark helpers that the operators share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidelane.session import new_folder


def written(frame: DataFrame, purpose: str, files: int | None = None) -> DataFrame:
    """The frame, written once to the shared folder and read again, so that later jobs depend on files only.

    ``files`` is the most files to write: many small ones cost time, and a helper process of Java for each where Hadoop's native library is missing.
    """
    path = new_folder(frame.sparkSession, purpose)
    frame = frame.coalesce(files) if files else frame
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def unused(frame: DataFrame, name: str) -> str:
    """``name``, lengthened until the frame has no such column (Spark ignores case)."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def field(frame: DataFrame, name: str) -> str:
    """One column's name and type as a schema string."""
    return f"`{name}` {frame.schema[name].dataType.simpleString()}"


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if they see that folder; else ship it with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
