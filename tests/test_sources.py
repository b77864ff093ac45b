import json

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from tidelane import session
from tidelane.operators import jsonl
from tidelane.operators.schema import changed_columns
from tidelane.sources.connectors import CatalogSource, FileSource, JdbcSource, Split, split_conditions, with_source_types
from tidelane.types import canonical


def test_file_source(spark):
    source = FileSource(spark, "/root/testdata/sf0.001")
    assert {"events", "region"} <= set(source.table_names())
    assert source.read("region").count() == 5
    assert FileSource(spark, session.new_folder(spark, "nothing")).table_names() == []


@pytest.mark.parametrize("kind", ["orc", "json", "csv"])
def test_other_formats(spark, kind):
    root = session.new_folder(spark, "formats")
    spark.range(3).write.option("header", "true").format(kind).save(f"{root}/t.{kind}")
    source = FileSource(spark, root, kind, f".{kind}", {"header": "true", "inferSchema": "true"})
    assert source.table_names() == ["t"]
    assert sorted(int(r["id"]) for r in source.read("t").collect()) == [0, 1, 2]


def test_catalog_source_leaves_views_out(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    spark.range(2).write.mode("overwrite").saveAsTable("shop.b_items")
    spark.range(1).write.mode("overwrite").saveAsTable("shop.a_items")
    spark.range(1).createOrReplaceTempView("passing")
    source = CatalogSource(spark, "shop")
    assert source.table_names() == ["a_items", "b_items"]
    assert source.read("b_items").count() == 2


def test_jdbc_options(spark):
    source = JdbcSource(
        spark, "jdbc:postgresql://host/db", {"user": "u"}, splits={"orders": Split("id", "1", "1000", 16)}
    )
    assert source.table_options("users") == {
        "user": "u", "url": "jdbc:postgresql://host/db", "dbtable": '"public"."users"', "fetchsize": "10000",
    }
    split = source.table_options("orders")
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id", "1", "1000", "16",
    )
    assert "table_schema = 'public'" in source.catalog_options()["dbtable"]


def test_jsonl_lines(spark):
    path = session.new_folder(spark, "jsonl")
    rows = spark.sql("SELECT 'é\n' AS b, CAST(NULL AS INT) AS a, X'00FF' AS c, "
                     "TIMESTAMP_NTZ '2024-01-01 00:00:00.000001' AS at")
    jsonl.append_jsonl(rows, path)
    jsonl.append_jsonl(rows, path)
    (line,) = {r["value"] for r in spark.read.option("recursiveFileLookup", "true").text(path).collect()}
    assert list(json.loads(line)) == ["a", "at", "b", "c"]
    assert json.loads(line) == {"a": None, "at": "2024-01-01T00:00:00.000001", "b": "é\n", "c": "AP8="}
    back = jsonl.read_jsonl(spark, path, rows.schema)
    assert back.count() == 2 and back.select(rows.columns).head() == rows.head()


def test_summary_counts_bytes_as_files_do(spark):
    root = session.new_folder(spark, "jsonl")
    jsonl.append_jsonl(spark.range(1000), f"{root}/numbers")
    jsonl.append_jsonl(spark.range(1).select(F.lit("é").alias("x")), f"{root}/words")
    found = {r["table_name"]: r for r in jsonl.table_summary(spark, root).collect()}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/numbers")
    assert found["numbers"]["bytes"] == files.agg(F.sum("length")).head()[0]
    assert (found["numbers"]["rows"], found["words"]["size"]) == (1000, '11 B')


def test_shared_folder_is_the_sessions(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")


def test_json_columns_of_a_database_are_told_from_strings(spark):
    rows = spark.sql("SELECT 1L AS id, '{}' AS doc, 'x' AS note, array('{}') AS docs")
    columns = spark.sql("SELECT * FROM VALUES ('id', 20L), ('doc', 3802L), ('note', 25L), ('docs', 3807L) AS t(name, type_oid)")
    typed = with_source_types(rows, columns)
    assert [canonical(f)[0] for f in typed.schema.fields] == ["INT64", "JSON", "STRING", "REPEATED"]
    plain = changed_columns(typed.schema, rows.schema)
    assert [(c["name"], c["change_type"]) for c in plain] == [("doc", "type_incompatible")]


def test_names_in_catalog_queries_are_quoted(spark):
    options = JdbcSource(spark, "jdbc:postgresql://host/db", schema="a'b").type_options("o'c")
    assert """to_regclass('"a''b"."o''c"')""" in options["dbtable"]


@pytest.mark.parametrize("inside", ["plain/t", "with space", "a+b%20c/t"])
def test_summary_names_the_folder_below_the_root(spark, inside):
    root = f"{session.new_folder(spark, 'jsonl')}/{inside}"
    for table, rows in (("t", 3), ("two words", 2), ("c+d", 1)):
        jsonl.append_jsonl(spark.range(rows), f"{root}/{table}", "l_1")
    found = {(r["table_name"], r["rows"]) for r in jsonl.table_summary(spark, root).collect()}
    assert found == {("t", 3), ("two words", 2), ("c+d", 1)}


@pytest.mark.parametrize("sql", [
    "id", "IF(id % 3 = 0, 7, id)", "IF(id % 10 = 0, NULL, id)", "DATE '2024-01-01' + CAST(id % 50 AS INT)", "id / 7",
    "TIMESTAMP_NTZ '2024-01-01 00:00:00.000001' + make_interval(0, 0, 0, 0, id)", "7", "CAST(NULL AS INT)", "IF(id % 4 = 0, double('NaN'), id / 3)",
])
def test_split_conditions_meet_every_row_once_in_even_ranges(spark, sql):
    rows = spark.sql(f"SELECT id, {sql} AS c FROM range(2000)")
    conditions = split_conditions(rows, "c", 8)
    met = rows.select(*(F.expr(c).eqNullSafe(F.lit(True)).cast("int").alias(f"r{i}") for i, c in enumerate(conditions)))
    assert met.where(sum(F.col(c) for c in met.columns) != 1).count() == 0
    sizes = sorted((met.where(F.col(c) == 1).count() for c in met.columns), reverse=True)
    most = rows.groupBy("c").count().agg(F.max("count")).head()[0]
    assert len(conditions) <= 18 and (sizes[0] <= max(2 * 2000 / 8, most) or "NaN" in sql)


def test_split_conditions_of_an_older_copy_still_cover_everything(spark):
    conditions = split_conditions(spark.range(100), "id", 4)
    later = spark.range(-50, 500)
    assert sum(later.where(c).count() for c in conditions) == 550
    assert split_conditions(spark.range(0), "id", 4) == ["id IS NOT NULL", "id IS NULL"] == split_conditions(spark.range(9), "id", 1)


def test_conditions_are_handed_to_the_jdbc_reader(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, **more: seen.update(more, url=url, table=table))
    source = JdbcSource(spark, "jdbc:postgresql://host/db", {"user": "u"}, splits={"orders": ["id < 5", "id >= 5", "id IS NULL"]})
    source.read("orders")
    assert seen == {
        "url": "jdbc:postgresql://host/db", "table": '"public"."orders"', "predicates": ["id < 5", "id >= 5", "id IS NULL"],
        "properties": {"user": "u", "fetchsize": "10000"},
    }
