"""Looking at a plan without moving data: what a sync would see, change and refuse."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.frames import small_frame
from tidelane.operators import monitor, schema
from tidelane.operators.table import SyncTable
from tidelane.plans.sync import TablePlan
from tidelane.sources.connectors import Source
from tidelane.types import schema_rows

PLAN = T.StructType([
    T.StructField("position", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("sync_mode", T.StringType()),
    T.StructField("cursor_field", T.StringType()),
    T.StructField("destination_table", T.StringType()),
    T.StructField("timeout_minutes", T.DoubleType()),
])


def plan_frame(spark: SparkSession, plan: Iterable[TablePlan]) -> DataFrame:
    return small_frame(spark, [{"position": i, **vars(p)} for i, p in enumerate(plan)], PLAN)


def dry_run(spark: SparkSession, plan: Iterable[TablePlan], source: Source) -> DataFrame:
    """Every planned table's columns as the source has them now."""
    plan = list(plan)
    columns = schema_rows(spark, {p.name: source.read(p.name).schema for p in plan})
    return schema.schema_preview(plan_frame(spark, plan), columns)


def pending_changes(spark: SparkSession, plan: Iterable[TablePlan], source: Source, destination: str) -> DataFrame:
    """The schema changes the next sync would apply, or halt at."""
    plan = list(plan)
    now = {p.destination: SyncTable(spark, destination, p.destination).schema() for p in plan}
    return schema.schema_diff(
        schema_rows(spark, {p.destination: source.read(p.name).schema for p in plan}),
        schema_rows(spark, {name: columns for name, columns in now.items() if columns is not None}),
    )


def validate(spark: SparkSession, plan: Iterable[TablePlan], source: Source) -> DataFrame:
    """What is wrong with a plan, as ``(name, problem)``: broken rules, then tables the source lacks."""
    rows = plan_frame(spark, plan)
    broken = monitor.validate_plan(rows).join(rows.select("position", "name"), "position")
    names = T.StructType([T.StructField("table_name", T.StringType())])
    have = small_frame(spark, [{"table_name": n} for n in source.table_names()], names)
    lost = monitor.missing_tables(rows.where("coalesce(name, '') <> ''"), have)
    return broken.select("name", F.col("violation").alias("problem")).unionAll(
        lost.select("name", F.lit("not found in source").alias("problem"))
    )
