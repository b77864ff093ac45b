"""Session helpers: the settings the operators are tuned for and the shared folder they write to."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Settings worth having on any cluster that runs these operators. They are a recommendation for
# whoever builds the session; the library never changes the settings of a session it is given.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.scheduler.mode": "FAIR",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or else a folder below the session's warehouse.

    On a cluster both must be on storage that all executors share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/tidelane"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if they see that folder; else ship it with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
