"""Tables that loads change in place, and types that grow with them."""

import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StringType

from sluicework.operators.evolve import widened_type
from sluicework.operators.merge import (
    CHANGE_TYPE,
    change_feed,
    merge_always,
    merge_insert,
    merge_newer,
    merge_with_changes,
    net_changes,
)
from sluicework.sources.tables import compact_small_files, create_table, merge_table, read_load_changes, read_table

KIND = "id INT, inc INT, v STRING, p STRING"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(spark, path):
    """Files with rows of the state, by partition."""
    from sluicework.sources.tables import STATE, _rows

    found = _rows(spark, path, STATE).select("p", F.input_file_name()).distinct().collect()
    return {p: {f for q, f in found if q == p} for p, _ in found}


@pytest.fixture(params=["broadcast", "shuffled"])
def session(spark, request):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffled":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


OLD = "id INT, inc INT, s STRUCT<x: INT, y: INT>, a ARRAY<STRUCT<k: INT, n: INT>>, m MAP<STRING, STRUCT<q: INT>>"
NEW = "m MAP<STRING, STRUCT<r: STRING, q: BIGINT>>, a ARRAY<STRUCT<n: BIGINT, k: INT, u: STRING>>, s STRUCT<y: BIGINT, z: STRING, x: INT>, inc INT, id BIGINT"
BIG = 5_000_000_000


def test_fields_go_by_name_and_types_widen(session):
    stored = session.createDataFrame([(1, 1, (10, 11), [(1, 2)], {"a": (3,)}), (2, 9, (20, 21), None, None)], OLD)
    batch = session.createDataFrame(
        [({"b": ("r", BIG)}, [(BIG, 4, "u")], (BIG, "z", 5), 2, 1), ({}, [], None, 2, 2), (None, None, (7, None, 6), 2, 7)], NEW
    )
    updated = (1, 2, (5, BIG, "z"), [(4, BIG, "u")], {"b": (BIG, "r")})
    kept = (2, 9, (20, 21, None), None, None)
    new = (7, 2, (6, 7, None), None, None)
    for merge, extra, expected in (
        (merge_newer, ["inc"], [updated, kept, new]),
        (merge_always, [], [updated, (2, 2, None, [], {}), new]),
        (merge_insert, [], [(1, 1, (10, 11, None), [(1, 2, None)], {"a": (3, None)}), kept, new]),
    ):
        merged = merge(stored, batch, "id", *extra)
        assert merged.schema.simpleString() == (
            "struct<id:bigint,inc:int,s:struct<x:int,y:bigint,z:string>,a:array<struct<k:int,n:bigint,u:string>>,m:map<string,struct<q:bigint,r:string>>>"
        )
        found = [(r.id, r.inc, r.s and tuple(r.s), r.a if r.a is None else [tuple(x) for x in r.a], r.m if r.m is None else {k: tuple(v) for k, v in r.m.items()}) for r in merged.collect()]
        assert sorted(found, key=str) == sorted(expected, key=str)
    with pytest.raises(ValueError, match="evolve is off"):
        merge_newer(stored, batch, "id", "inc", evolve=False)


def test_inner_fields_that_a_batch_lacks_keep_their_value(session):
    stored = session.createDataFrame([(1, 1, (1, 2, (3, 4)))], "id INT, inc INT, s STRUCT<x: INT, y: INT, t: STRUCT<a: INT, b: INT>>")
    batch = session.createDataFrame([(1, 2, (((9,)), 8))], "id INT, inc INT, s STRUCT<t: STRUCT<b: INT>, x: INT>")
    (found,) = merge_newer(stored, batch, "id", "inc").collect()
    assert tuple(found.s) == (8, 2, (3, 9))


@pytest.mark.parametrize(
    "ours, theirs, wider",
    [
        (IntegerType(), LongType(), LongType()),
        (LongType(), IntegerType(), LongType()),
        (IntegerType(), DoubleType(), DoubleType()),
        (DecimalType(5, 2), IntegerType(), DecimalType(12, 2)),
        (DecimalType(38, 10), DecimalType(38, 0), DoubleType()),
        (IntegerType(), StringType(), IntegerType()),
        (StringType(), IntegerType(), StringType()),
    ],
)
def test_wider_types(ours, theirs, wider):
    assert widened_type(ours, theirs) == wider


def test_values_that_do_not_fit_are_null(session):
    stored = session.createDataFrame([(1, 1, "7"), (2, 1, "x")], "id INT, inc INT, v STRING").withColumn("v", F.expr("try_cast(v AS INT)"))
    batch = session.createDataFrame([(1, 2, "no number"), (3, 2, "12")], "id INT, inc INT, v STRING")
    assert rows(merge_newer(stored, batch, "id", "inc")) == [(1, 2, None), (2, 1, None), (3, 2, 12)]


def test_state_and_changes_of_one_merge(session):
    stored = session.createDataFrame([(1, 5, "t", "a"), (1, 5, "u", "a"), (2, 5, "t", "a"), (3, None, "t", "b"), (None, 5, "t", "b"), (9, 5, "t", "c")], KIND)
    batch = session.createDataFrame([(1, 6, "s", "b"), (2, 5, "s", "a"), (3, 6, "s", "b"), (None, 9, "s", "c"), (7, 1, "s", "c"), (7, 1, "s", "c"), (9, 6, None, None)], KIND)
    for merge, extra, options in (
        (merge_newer, ["inc"], {}), (merge_newer, ["inc"], {"fill_nulls": True}), (merge_always, [], {}), (merge_insert, [], {"insert_only": True}),
    ):
        both = merge_with_changes(stored, batch if merge is not merge_always else batch.where("id <> 7"), "id", *extra, **options)
        source = batch if merge is not merge_always else batch.where("id <> 7")
        plain = {k: v for k, v in options.items() if k != "insert_only"}
        after = merge(stored, source, "id", *extra, **plain)
        assert rows(both.where("_output = 'state'").drop("_output", CHANGE_TYPE)) == rows(after)
        assert rows(both.where("_output = 'changes'").drop("_output")) == rows(change_feed(stored, after, "id"))


def test_merge_with_changes_reads_each_side_once(spark, tmp_path, shuffled):
    for name in ("t", "s"):
        spark.range(50).select("id", F.lit(1).alias("inc"), F.lit(name).alias("v")).write.parquet(str(tmp_path / name))
    stored, batch = (spark.read.parquet(str(tmp_path / n)) for n in ("t", "s"))
    plan = merge_with_changes(stored, batch, "id", "inc")._jdf.queryExecution().executedPlan().toString()
    initial = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    assert initial.count("FileScan") == 2 and initial.count("SortMergeJoin") == 1


def test_netted_changes_are_those_of_the_ends(spark):
    states = [
        [(1, 1, "a", "p"), (2, 1, "a", "p"), (None, 1, "n", "p"), (5, 1, "x", "p"), (5, 1, "x", "p")],
        [(1, 2, "b", "p"), (3, 2, "new", "q"), (None, 1, "n", "p"), (None, 2, "m", "p"), (5, 1, "x", "p"), (5, 1, "y", "p")],
        [(1, 3, "c", "q"), (2, 3, "back", "p"), (None, 2, "m", "p"), (5, 1, "x", "p"), (5, 1, "x", "p"), (6, 3, "late", "q")],
        [(1, 1, "a", "p"), (2, 3, "back", "p"), (6, 4, "later", "q")],
    ]
    frames = [spark.createDataFrame(s, KIND) for s in states]
    feeds = [change_feed(a, b, "id") for a, b in itertools.pairwise(frames)]
    for first, last in itertools.combinations(range(4), 2):
        kept = feeds[first]
        for feed in feeds[first + 1 : last]:
            kept = kept.unionAll(feed)
        assert rows(net_changes(kept, "id")) == rows(change_feed(frames[first], frames[last], "id"))


def test_only_touched_partitions_are_written(session, tmp_path):
    path = str(tmp_path / "table")
    first = session.createDataFrame([(i, 1, "old", "abc"[i % 3]) for i in range(30)] + [(100, 1, "old", None), (None, 1, "old", "a")], KIND)
    create_table(first, path, "p")
    before = files(session, path)
    batch = session.createDataFrame(
        # an update, one that moves to a new partition, one not newer, a new row in a touched and in an untouched partition, one without key or partition
        [(0, 2, "new", "a"), (3, 2, "moved", "d"), (1, 1, "same age", "b"), (200, 2, "insert", "a"), (201, 2, "insert", "c"), (None, 2, "unnamed", None)],
        KIND,
    )
    expected = rows(merge_newer(first, batch, "id", "inc"))
    assert sorted(merge_table(session, path, batch, "id", "p", 1, "inc")) == ["a", "d"]
    assert rows(read_table(session, path)) == expected
    after = files(session, path)
    assert after["b"] == before["b"] and before["c"] < after["c"] and before[None] < after[None] and not after["a"] & before["a"]
    changed = rows(read_load_changes(session, path, "id", 0, 1))
    assert changed == rows(change_feed(first, session.createDataFrame(expected, KIND), "id"))
    # The same load again changes nothing; unnamed rows have no key to be known by.
    named = batch.where("id IS NOT NULL")
    assert merge_table(session, path, named, "id", "p", 1, "inc") == []
    assert rows(read_table(session, path)) == expected and rows(read_load_changes(session, path, "id", 0, 1)) == changed


def test_a_partition_that_all_rows_leave(session, tmp_path):
    path = str(tmp_path / "table")
    create_table(session.createDataFrame([(1, 1, "x", "a"), (2, 1, "x", "b")], KIND), path, "p")
    merge_table(session, path, session.createDataFrame([(1, 2, "y", "b")], KIND), "id", "p", 1, "inc")
    assert rows(read_table(session, path)) == [(1, 2, "y", "b"), (2, 1, "x", "b")]
    merge_table(session, path, session.createDataFrame([(3, 2, "z", "a")], KIND), "id", "p", 2, "inc")
    assert rows(read_table(session, path)) == [(1, 2, "y", "b"), (2, 1, "x", "b"), (3, 2, "z", "a")]


def test_only_partitions_with_small_files_are_compacted(spark, tmp_path):
    path = str(tmp_path / "table")
    wide = spark.range(3000).select(F.col("id").cast("int").alias("id"), F.lit(1).alias("inc"), F.sha2(F.col("id").cast("string"), 512).alias("v"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("p"), F.col("id") % 3)).alias("p"))
    create_table(wide.where("id < 2400"), path, "p")
    for load, part in enumerate(("p1", "p1", None, None), 1):
        rows_ = wide.where("id >= 2400").where(F.col("p").eqNullSafe(F.lit(part))).where(F.col("id") % 2 == load % 2)
        merge_table(spark, path, rows_, "id", "p", load, "inc")
    before = files(spark, path)
    assert {p: len(f) for p, f in before.items()} == {"p1": 3, "p2": 1, None: 3}
    assert sorted(compact_small_files(spark, path, "p", file_bytes=200_000), key=str) == [None, "p1"]
    after = files(spark, path)
    assert after["p2"] == before["p2"] and all(len(after[p]) == 1 and not after[p] & before[p] for p in ("p1", None))
    assert rows(read_table(spark, path)) == rows(wide.where("id < 2400 OR p IS NULL OR p = 'p1'"))
    assert compact_small_files(spark, path, "p", file_bytes=200_000) == []


def test_types_grow_over_loads(session, tmp_path):
    path = str(tmp_path / "table")
    create_table(session.createDataFrame([(1, 1, (1,), "a"), (2, 1, (2,), "b")], "id INT, inc INT, s STRUCT<x: INT>, p STRING"), path, "p")
    batch = session.createDataFrame([(BIG, 2, ("q", BIG), "c"), (1, 2, ("r", BIG), "a")], "id BIGINT, inc INT, s STRUCT<z: STRING, x: BIGINT>, p STRING")
    merge_table(session, path, batch, "id", "p", 1, "inc")
    found = sorted((r.id, tuple(r.s), r.p) for r in read_table(session, path).collect())
    assert found == [(1, (BIG, "r"), "a"), (2, (2, None), "b"), (BIG, (BIG, "q"), "c")]
    assert {(r.id, r[CHANGE_TYPE]) for r in read_load_changes(session, path, "id", 0, 1).collect()} == {(1, "update_preimage"), (1, "update_postimage"), (BIG, "insert")}


def test_other_kinds_of_load(session, tmp_path):
    path = str(tmp_path / "table")
    first = session.createDataFrame([(1, 1, "x", "a"), (2, 1, None, "b")], KIND)
    create_table(first, path, "p")
    batch = session.createDataFrame([(1, 0, None, "a"), (3, 1, "n", "b")], KIND)
    assert merge_table(session, path, batch, "id", "p", 1, insert_only=True) == []
    assert rows(read_table(session, path)) == rows(merge_insert(first, batch, "id"))
    merge_table(session, path, batch, "id", "p", 2)
    assert rows(read_table(session, path)) == [(1, 0, None, "a"), (2, 1, None, "b"), (3, 1, "n", "b")]
    partial = session.createDataFrame([(3, 2, None, "b")], KIND)
    merge_table(session, path, partial, "id", "p", 3, "inc", fill_nulls=True)
    assert (3, 2, "n", "b") in rows(read_table(session, path))
    ends = rows(change_feed(first, read_table(session, path), "id"))
    assert rows(read_load_changes(session, path, "id", 0, 3)) == ends


def test_empty_tables_and_batches(spark, tmp_path):
    path = str(tmp_path / "table")
    none = spark.createDataFrame([], KIND)
    create_table(none, path, "p")
    assert read_table(spark, path).collect() == [] and merge_table(spark, path, none, "id", "p", 1, "inc") == []
    assert read_load_changes(spark, path, "id", 0, 1).collect() == []
    merge_table(spark, path, spark.createDataFrame([(1, 1, "x", "a")], KIND), "id", "p", 1, "inc")
    assert rows(read_table(spark, path)) == [(1, 1, "x", "a")]
