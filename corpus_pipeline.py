"""A corpus pipeline: quality rules, line dedup, near-duplicates, decontamination, then encoding.

Each stage takes (spark, docs, sf_dir), where ``docs`` has the columns of ``documents``, and works on all that the stage before
kept. Only the last one returns other columns. SQL expresses neither sampling nor encoding, so there is no SQL; the tests hold the
rows against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.llm import decontaminate, lines, neardup, pieces, quality
from tidelane.llm.frames import find_package, unused, written
from tidelane.llm.queries import PIECE_MODEL, read

ORACLE_SQL = None

#: A document that is no twentieth benchmark may still hold whole items: longer runs of hit words than this are cut out.
LONGEST_SPAN = 25


def _counted(docs: DataFrame) -> DataFrame:
    """The documents with ``n_chars``, where they have it, as their texts are now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the calibrated rules let pass."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less their sources' boilerplate lines; one that would lose all keeps them if its source has a copy."""
    found = unused(docs, "found")
    return _counted(lines.drop_boilerplate(docs, found, keep_whole=True).drop(found))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that of the least doc_id."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is in windows of benchmark items, less the spans of over ``LONGEST_SPAN`` hit words."""
    return _counted(decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"), longest=LONGEST_SPAN))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of all documents at a dropout rate of 0.1."""
    found = unused(docs, "found")
    out = pieces.encode(docs.select("doc_id", "text"), PIECE_MODEL, found)
    return out.select("doc_id", f"{found}.n_tokens", f"{found}.ids", f"{found}.lossless")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicates", near_dedup),
    ("decontamination", decontamination),
    ("piece encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    find_package(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
