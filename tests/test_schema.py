import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.frames import small_frame
from tidelane.functions.typemap import TYPE_ORDER, is_widening, map_source_type_names, map_source_types, widens
from tidelane.operators import schema as S
from tidelane.types import CANONICAL_TYPES, SCHEMA_ROWS, canonical, schema_from_rows, schema_rows, spark_type, stored_schema

# The ten pairs that may be widened; all other pairs of different types are incompatible.
SAFE = {
    ("INT64", "FLOAT64"), ("INT64", "NUMERIC"), ("INT64", "STRING"), ("FLOAT64", "NUMERIC"), ("FLOAT64", "STRING"),
    ("NUMERIC", "STRING"), ("BOOL", "STRING"), ("DATE", "TIMESTAMP"), ("DATE", "STRING"), ("TIMESTAMP", "STRING"),
}


def rows(spark, *columns, table="t"):
    names = ("name", "type", "item_type")
    data = [
        {"table_name": table, "ordinal": i, "nullable": True, **dict(zip(names, c))} for i, c in enumerate(columns, 1)
    ]
    return small_frame(spark, data, SCHEMA_ROWS)


def diff(source, dest, **options):
    found = S.schema_diff(source, dest, **options).orderBy(*S.change_order())
    return [(r["name"], r["change_type"]) for r in found.collect()]


def test_every_pair_of_types(spark):
    pairs = [(old, new) for old in CANONICAL_TYPES for new in CANONICAL_TYPES]
    dest = rows(spark, *((f"c{i}", old) for i, (old, _) in enumerate(pairs)))
    source = rows(spark, *((f"c{i}", new) for i, (_, new) in enumerate(pairs)))
    found = dict(diff(source, dest))
    for i, (old, new) in enumerate(pairs):
        wanted = None if old == new else S.TYPE_WIDEN if (old, new) in SAFE else S.TYPE_INCOMPATIBLE
        assert found.get(f"c{i}") == wanted, (old, new)
        assert widens(old, new) == ((old, new) in SAFE)


def test_unknown_old_type_is_no_widening(spark):
    frame = spark.range(1).select(is_widening(F.lit(None).cast("string"), F.lit("STRING")).alias("w"))
    assert frame.head()["w"] is False


def test_added_removed_and_changed_in_source_order(spark):
    source = rows(spark, ("new", "STRING"), ("id", "INT64"), ("price", "FLOAT64"), ("at", "JSON"))
    dest = rows(spark, ("gone", "BOOL"), ("id", "INT64"), ("price", "INT64"), ("at", "TIMESTAMP"))
    assert diff(source, dest) == [
        ("new", S.ADD_COLUMN), ("price", S.TYPE_WIDEN), ("at", S.TYPE_INCOMPATIBLE), ("gone", S.REMOVE_COLUMN),
    ]


def test_identical_and_absent_destinations_have_no_changes(spark):
    source = rows(spark, ("id", "INT64"), ("tags", "REPEATED", "STRING"))
    assert diff(source, source) == []
    assert diff(source, rows(spark)) == []
    assert diff(source, rows(spark, ("id", "INT64"), table="other")) == [("id", S.REMOVE_COLUMN)]


def test_item_drift_only_counts_when_strict(spark):
    source, dest = rows(spark, ("tags", "REPEATED", "INT64")), rows(spark, ("tags", "REPEATED", "STRING"))
    assert diff(source, dest) == []
    assert diff(source, dest, strict_items=True) == [("tags", S.TYPE_INCOMPATIBLE)]
    assert diff(source, source, strict_items=True) == []


def test_local_changes_agree_with_the_operator(spark):
    old = T.StructType().add("a", "integer").add("b", "date").add("c", "string").add("d", "binary")
    new = T.StructType().add("a", "double").add("b", "integer").add("d", "binary").add("e", "boolean")
    by_query = diff(schema_rows(spark, {"t": new}), schema_rows(spark, {"t": old}))
    local = [(c["name"], c["change_type"]) for c in S.local_changes(old, new)]
    assert by_query == local


def test_apply_changes_refuses_incompatible_ones():
    old, new = T.StructType().add("a", "string"), T.StructType().add("a", "integer")
    with pytest.raises(S.IncompatibleSchema):
        S.apply_changes(old, new, S.local_changes(old, new))


def test_apply_changes_adds_last_keeps_removed_and_widens():
    old = T.StructType().add("gone", "string").add("n", "long")
    new = T.StructType().add("new", "integer", False).add("n", "double")
    after = S.apply_changes(old, new, S.local_changes(old, new))
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in after.fields] == [
        ("gone", "string", True), ("n", "double", True), ("new", "bigint", True),
    ]


def test_decimals_grow_to_hold_both_sides():
    old, new = T.StructType().add("n", "decimal(12,2)"), T.StructType().add("n", "decimal(10,4)")
    assert S.local_changes(old, new) == []
    assert S.apply_changes(old, new, [])["n"].dataType == T.DecimalType(14, 4)
    with pytest.raises(S.IncompatibleSchema):
        S.apply_changes(T.StructType().add("n", "decimal(38,0)"), T.StructType().add("n", "decimal(38,9)"), [])


def test_align_refuses_what_was_not_agreed(spark):
    batch = spark.range(3)
    with pytest.raises(S.IncompatibleSchema):
        S.align_batch(batch, T.StructType().add("other", "long"))
    with pytest.raises(S.IncompatibleSchema):
        S.align_batch(batch, T.StructType().add("id", "boolean"))


def test_align_overflow_is_an_error_not_a_null(spark):
    batch = spark.range(1).select(F.lit(1e30).alias("x"))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        S.align_batch(batch, T.StructType().add("x", "decimal(38,9)")).collect()


def test_complex_columns_become_json_text(spark):
    batch = spark.sql("SELECT named_struct('a', 1) AS s, map('k', 2) AS m, array(array(1)) AS n, array('x') AS t")
    target = stored_schema(batch.schema)
    assert [f.dataType.simpleString() for f in target.fields] == ["string", "string", "string", "array<string>"]
    assert tuple(S.align_batch(batch, target).head()) == ('{"a":1}', '{"k":2}', "[[1]]", ["x"])


def test_schema_rows_round_trip(spark):
    schema = T.StructType([
        T.StructField("id", T.LongType(), False), T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("doc", T.StringType(), True, {"canonical": "JSON"}), T.StructField("at", T.TimestampType()),
    ])
    back = schema_from_rows([r.asDict() for r in schema_rows(spark, {"t": schema}).collect()])
    assert back == schema
    assert [canonical(f) for f in back.fields] == [
        ("INT64", None), ("REPEATED", "STRING"), ("JSON", None), ("TIMESTAMP", None),
    ]
    assert spark_type("no such type") == T.StringType()


def test_source_type_numbers(spark):
    frame = spark.sql("SELECT * FROM VALUES (20), (1009), (199), (0), (600) AS v(type_oid)")
    found = {r["type_oid"]: (r["type"], r["item_type"], r["known"]) for r in map_source_types(frame).collect()}
    assert found == {
        20: ("INT64", None, True), 1009: ("REPEATED", "STRING", True), 199: ("REPEATED", "JSON", True),
        0: ("STRING", None, False), 600: ("STRING", None, False),
    }


def test_source_type_names(spark):
    names = ["uuid", "text[]", "jsonb[][]", "money", "money[]", "[]", "[]text"]
    frame = spark.createDataFrame([(n,) for n in names], "type_name string")
    found = {r["type_name"]: (r["type"], r["item_type"], r["known"]) for r in map_source_type_names(frame).collect()}
    unknown = ("STRING", None, False)
    assert found == {
        "uuid": ("STRING", None, True), "text[]": ("REPEATED", "STRING", True),
        "jsonb[][]": ("REPEATED", "REPEATED", True), "money": unknown, "money[]": unknown, "[]": unknown,
        "[]text": unknown,
    }


def common(spark, *versions):
    """``(type, item_type)`` versions of one column."""
    rows = [("t", i, "c", k, item, i % 2 == 1) for i, (k, item) in enumerate(versions)]
    frame = spark.createDataFrame(rows, "table_name string, ordinal int, name string, type string, item_type string, nullable boolean")
    return [(r["type"], r["item_type"], r["versions"], r["nullable"]) for r in S.common_types(frame.repartition(3)).collect()]


def test_the_common_type_of_many_versions_is_the_narrowest_that_all_widen_to(spark):
    plain = lambda *kinds: [(k, None) for k in kinds]
    assert common(spark, *plain("INT64", "INT64")) == [("INT64", None, 2, True)]
    assert common(spark, *plain("NUMERIC", "INT64", "FLOAT64"))[0][0] == "NUMERIC"
    assert common(spark, *plain("INT64", "FLOAT64"))[0][0] == "FLOAT64"
    assert common(spark, *plain("DATE", "TIMESTAMP"))[0][0] == "TIMESTAMP"
    assert common(spark, *plain("DATE", "INT64", "BOOL"))[0][0] == "STRING"  # each becomes text, none the other
    assert common(spark, *plain("JSON", "STRING"))[0][0] is None and common(spark, *plain("BYTES", "INT64"))[0][0] is None
    assert common(spark, ("REPEATED", "INT64"), ("REPEATED", "FLOAT64"))[0][:2] == ("REPEATED", "FLOAT64")
    assert common(spark, ("REPEATED", "INT64"), ("REPEATED", "JSON"))[0][:2] == (None, None)
    assert common(spark, ("REPEATED", "INT64"), ("STRING", None))[0][:2] == (None, None)
    assert common(spark, *plain(None, "BOOL"))[0] == ("BOOL", None, 1, True) and common(spark) == []


def test_the_common_type_is_reached_by_allowed_changes_only(spark):
    for kinds in itertools.product(CANONICAL_TYPES[:9], repeat=3):
        able = [t for t in TYPE_ORDER if all(t == k or widens(k, t) for k in kinds)]
        if len(able) > 1:  # the choice widens to every other candidate
            assert all(widens(able[0], other) for other in able[1:]), kinds
