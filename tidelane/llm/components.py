"""Connected components of links between texts, by large and small stars, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelane.llm.frames import written


def components(links: DataFrame, files: int | None = None) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a`` and ``b``) that is not its component's least node.

    Each round joins every node's neighbours to the least of them, first upwards and then downwards, and is written to the
    shared folder, as ``files`` files at most. The rounds needed grow with the logarithm of the nodes. Links in either direction, doubled ones and
    loops are allowed; without links there are no rows.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(least.where("a != m")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.union(least).distinct(), "components", files)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
