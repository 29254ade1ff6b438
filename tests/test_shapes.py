import json

import pytest
from pyspark.sql import functions as F
from pyspark.testing.utils import assertDataFrameEqual

from sluicework.operators import nested, schema

# The contacts, and the rows they must give.
CONTACTS = "id BIGINT, name STRING, contacts ARRAY<STRUCT<type: STRING, value: STRING>>"


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [
            (1, "Alice", [("email", "alice@example.com"), ("phone", "123-456-7890")]),
            (2, "Bob", [("email", "bob@example.com"), ("phone", "234-567-8901")]),
            (3, "Charlie", [("email", "charlie@example.com")]),
        ],
        CONTACTS,
    )


def test_flatten_contacts(spark, people):
    expected = spark.createDataFrame(
        [
            (1, "Alice", "email", "alice@example.com"),
            (1, "Alice", "phone", "123-456-7890"),
            (2, "Bob", "email", "bob@example.com"),
            (2, "Bob", "phone", "234-567-8901"),
            (3, "Charlie", "email", "charlie@example.com"),
        ],
        "id BIGINT, name STRING, contacts_type STRING, contacts_value STRING",
    )
    assertDataFrameEqual(people.transform(nested.flatten), expected)
    assert nested.flatten(people, ["id"]).columns == ["id"]


def test_pivot_contacts(spark, people):
    expected = spark.createDataFrame(
        [
            (1, "Alice", "alice@example.com", "123-456-7890"),
            (2, "Bob", "bob@example.com", "234-567-8901"),
            (3, "Charlie", "charlie@example.com", None),
        ],
        "id BIGINT, name STRING, email STRING, phone STRING",
    )
    assertDataFrameEqual(people.transform(nested.pivot, "contacts", "type"), expected)
    wide = nested.pivot(people, "contacts", "type", ["email", "phone"], distinct_rows=True)
    assertDataFrameEqual(wide, expected)
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()


def test_pivot_edge_cases(spark):
    rows = spark.createDataFrame(
        [
            (1, [("a", 1, "x"), ("a", 2, "y"), (None, 3, "z")]),
            (2, []),
            (3, None),
            (4, [None, ("b", None, "w")]),
            (4, [("b", 9, "v")]),
        ],
        "id INT, items ARRAY<STRUCT<k: STRING, n: INT, t: STRING>>",
    )
    wide = nested.pivot(rows, "items", "k")
    assert wide.columns == ["id", "a_n", "a_t", "b_n", "b_t"]
    assert sorted(map(tuple, wide.collect())) == [
        (1, 1, "x", None, None),
        (2, None, None, None, None),
        (3, None, None, None, None),
        (4, None, None, 9, "v"),
    ]
    kept = nested.pivot(rows, "items", "k", null_key=True)
    assert kept.columns[-2:] == ["null_n", "null_t"]
    assert schema.drop_null_key_columns(kept).columns == wide.columns
    spark.conf.set("spark.sql.pivotMaxValues", "1")
    try:
        with pytest.raises(ValueError, match="more than 1"):
            nested.pivot(rows, "items", "k")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


EVENT = {
    "_id": "e1",
    "location": {"venue": "hall", "address": {"city": "X", "zip": "1"}, "geo": {"lat": 1.5}},
    "organizer": {"contact": {"email": "o@example.com"}},
    "attendees": [{"name": "J", "kind": "VIP"}, {"name": "K", "kind": "Std"}],
    "sessions": [{"id": "s1"}, {"id": "s2"}],
    "sponsors": [{"name": "A", "level": "Gold"}, {"name": "B", "level": "Silver"}],
    "feedback": [{"rating": 5}, {"rating": 4}],
}


def test_event_document(spark, tmp_path):
    path = tmp_path / "event.json"
    path.write_text(json.dumps(EVENT, indent=1))
    event = spark.read.option("multiLine", "true").json(str(path))
    full = nested.flatten(event)
    assert full.count() == 16
    assert not any("struct" in kind or "array" in kind for _, kind in full.dtypes)
    single = nested.flatten_documents(event)
    assert single.count() == 1
    row = single.first()
    assert row["location_address_city"] == "X" and row["sponsors"] == "{Gold, A}, {Silver, B}"
    some = nested.flatten_documents(event, {"sessions": "explode", "sponsors": nested.Pivot("level")})
    assert some.count() == 2 and {"Gold", "Silver", "sessions_id"} <= set(some.columns)
    with pytest.raises(ValueError, match="4 arrays"):
        nested.flatten(event, max_arrays=3)


def test_flatten_keeps_rows_maps_and_odd_names(spark):
    rows = spark.sql(
        "SELECT 1 AS id, CAST(NULL AS STRUCT<x: INT>) AS s, CAST(array() AS ARRAY<INT>) AS a, "
        "map('k', 1) AS m, named_struct('c.d', 4) AS `p.q`"
    )
    flat = nested.flatten(rows)
    assert flat.columns == ["id", "m", "s_x", "p.q_c.d", "a"]
    assert tuple(flat.first()) == (1, {"k": 1}, None, 4, None)
    clash = spark.sql("SELECT 1 AS a_b, named_struct('B', 2) AS a")
    with pytest.raises(ValueError, match="a_B"):
        nested.flatten(clash)


def test_array_policies_of_entries():
    entries = [{"array_col": "a"}, {"array_col": "b", "pivot_col": "k"}]
    assert nested.policies_of(entries) == {"a": "explode", "b": nested.Pivot("k")}


def test_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(10).select("id", F.struct("id").alias("s"), F.array("id").alias("arr")).write.parquet(path)
    flat = nested.flatten(spark.read.parquet(path)).where("id = 3").select("id", "arr")
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,3)" in plan and "s:struct" not in plan


def test_rename_duplicate_columns(spark):
    df = spark.sql("SELECT NULL AS a, 1 AS b, 2 AS c").toDF("Tag", "N", "tag")
    assert schema.rename_duplicate_columns(df).collect()[0].asDict() == {"n": 1, "tag": 2}
    assert schema.rename_duplicate_columns(df.toDF("A", "b", "C.d")).columns == ["a", "b", "c.d"]


def test_remove_duplicate_columns(spark):
    df = spark.sql("SELECT 1, 2, 3, 4").toDF("x", "y", "x", "x")
    kept = schema.remove_duplicate_columns(df)
    assert kept.columns == ["y", "x"] and tuple(kept.first()) == (2, 4)


def test_filters_and_overrides(spark):
    df = spark.createDataFrame([("Open",), ("open",), (None,), ("shut",)], "s STRING")
    assert schema.filter_column(df, "s", "OPEN").count() == 2
    assert schema.filter_column(df, "s", "null").count() == 3
    assert schema.apply_filters(df, None).count() == 4
    entries = [{"column": "s", "value": "null"}, {"column": "s", "value": "shut", "unique_id": "u", "incremental_key": "i"}]
    assert schema.apply_filters(df, entries).count() == 1
    assert schema.key_overrides(entries) == {"unique_id": "u", "incremental_key": "i"}


def test_derived_key(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b")
    assert schema.select_with_key(df, ["a"], "a").columns == ["a"]
    assert tuple(schema.select_with_key(df, ["a"], "k", "a + b").first()) == (1, 3)
    with pytest.raises(ValueError):
        schema.select_with_key(df, ["a"], "k")
