"""Latest version of each row, for destinations that received some rows more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, keys: list[str], cursor: str, ties: list[str]) -> DataFrame:
    """The row with the largest cursor for each key, ties broken by the largest ``ties`` values.

    Spark reduces every map task to one row per key before it shuffles (a partial group limit), so a
    key that holds a large share of the rows sends one row per task.
    """
    newest = W.partitionBy(*keys).orderBy(F.col(cursor).desc_nulls_last(), *(F.col(t).desc_nulls_last() for t in ties))
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
