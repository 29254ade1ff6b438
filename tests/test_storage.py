import os
from datetime import datetime, timezone
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from sluicework.operators.layout import compact, cut_lineage, table_metrics
from sluicework.plans.ingest import ingest, raw_path, stage
from sluicework.sources import control, mongo, sinks
from sluicework.sources.files import read_files, read_sheet, unwrap_envelope
from sluicework.sources.scratch import scratch_dir, written_out
from sluicework.sources.versions import feed_options, read_changes, version_path


def files(path):
    return sorted(
        os.path.join(folder, name)
        for folder, _, names in os.walk(path)
        for name in names
        if name.startswith("part-")
    )


def test_watermark_prunes_files(spark, tmp_path):
    path = str(tmp_path)
    for name, year in (("old/deep", 2020), ("new", 2023)):
        spark.sql(f"SELECT named_struct('y', {year}) AS _airbyte_data").coalesce(1).write.json(f"{path}/{name}")
        for found in files(f"{path}/{name}"):
            stamp = datetime(year, 1, 1).timestamp()
            os.utime(found, (stamp, stamp))
    assert {r["y"] for r in read_files(spark, path, None, "json").collect()} == {2020, 2023}
    recent = read_files(spark, path, datetime(2022, 1, 1), "json", "postgress")
    assert [r["y"] for r in recent.collect()] == [2023]
    assert read_files(spark, path, "2016-01-01T00:00:00", "json", "kafka").columns == ["_airbyte_data"]
    kind = "_airbyte_data STRUCT<y: INT>"
    assert read_files(spark, path, "2030-01-01T00:00:00", "json", schema=kind).isEmpty()
    assert unwrap_envelope(spark.sql("SELECT named_struct('a', 1) AS e"), "e").columns == ["a"]


def test_sheet(spark, tmp_path):
    (tmp_path / "m.csv").write_text("A,B\n1,\n2,x\n")
    text = read_sheet(spark, str(tmp_path / "m.csv"))
    typed = read_sheet(spark, str(tmp_path / "m.csv"), infer_types=True)
    assert dict(text.dtypes) == {"A": "string", "B": "string"}
    assert [tuple(r) for r in typed.collect()] == [(1, None), (2, "x")]


def test_mongo_options():
    options = mongo.scan_options("mongodb://h/", "db", "c", [{"$match": {"a": 1}}], sample_size=5)
    assert options == {
        "connection.uri": "mongodb://h/",
        "database": "db",
        "collection": "c",
        "inferSchema": "true",
        "samplePoolSize": "1000000",
        "sampleSize": "5",
        "aggregation.pipeline": '[{"$match": {"a": 1}}]',
    }
    assert "aggregation.pipeline" not in mongo.scan_options("u", "d", "c")
    assert mongo.connection_options("u", "d", "c", readPreference="secondary")["readPreference"] == "secondary"


def test_mongo_failures_raise(spark):
    """Without the connector on the classpath every use fails loudly."""
    with pytest.raises(Exception, match="mongodb"):
        mongo.read(spark, "mongodb://h/", "d", "c")
    with pytest.raises(Exception, match="mongodb"):
        mongo.write(spark.range(1), "mongodb://h/", "d", "c")


def test_sized_and_counted_writes(spark, tmp_path):
    rows = spark.range(0, 250, 1, 1)
    assert sinks.write_sized(rows, str(tmp_path / "sized"), rows_per_file=100) == 250
    assert sinks.write_sized(rows.where("false"), str(tmp_path / "empty")) == 0
    assert len(files(tmp_path / "sized")) == 3
    assert sinks.write_counted(rows, str(tmp_path / "counted"), rows_per_file=100) == 250
    assert len(files(tmp_path / "counted")) == 3
    assert sinks.write_counted(rows.where("id < 0"), str(tmp_path / "none")) == 0
    assert not os.path.exists(tmp_path / "none")


def test_ingest_partitions(spark, tmp_path):
    path = raw_path(str(tmp_path), "mongo", "Shop", "Orders")
    assert path.endswith("/raw/mongo/shop/orders")
    ingest(spark.range(5), path, datetime(2024, 6, 2, 7))
    assert os.path.isdir(f"{path}/ingest_year=2024/ingest_month=06/ingest_day=02/ingest_hour=07")
    assert spark.read.json(path).count() == 5


def test_staging_is_dated_gzip(spark, tmp_path):
    spark.range(10).toDF("ID").write.json(str(tmp_path / "in"))
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    assert stage(spark, source, target, "2020-01-01T00:00:00", "json", day="2024-01-02") == 10
    assert stage(spark, source, target, control.NEVER_LOADED, "json", day="2024-01-01") == 10
    assert len(files(tmp_path / "out" / "2024-01-01")) > 1
    found = files(tmp_path / "out" / "2024-01-02")
    assert len(found) == 1 and found[0].endswith(".json.gz")
    assert spark.read.json(str(tmp_path / "out" / "2024-01-02")).columns == ["id"]


def test_one_file_per_partition_directory(spark, tmp_path):
    rows = spark.range(0, 3000, 1, 6).select("id", (F.col("id") % 3).alias("p"))
    sinks.write_partitioned(rows, str(tmp_path / "t"), "p")
    assert len(files(tmp_path / "t")) == 3
    sinks.write_partitioned(rows, str(tmp_path / "u"), "p", shuffle=False)
    assert len(files(tmp_path / "u")) == 18


def test_hot_partition_value_is_split(spark, tmp_path):
    """Rebalancing cuts a partition value that outgrows the advisory size."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 200_000, 1, 16).select(F.xxhash64("id").alias("v"), F.lit("hot").alias("p"))
        sinks.write_partitioned(rows, str(tmp_path / "t"), "p")
        assert len(files(tmp_path / "t")) > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_compaction_and_metrics(spark, tmp_path):
    rows = spark.range(0, 20_000, 1, 20).select(F.lit(1).alias("c"), F.xxhash64("id").alias("v"))
    rows.write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    found = table_metrics(many).first()
    sizes = sum(os.path.getsize(f) for f in files(tmp_path / "many"))
    assert tuple(found) == (20_000, 20, sizes)
    assert compact(many, sizes).rdd.getNumPartitions() == 1
    ranged = compact(many, sizes, ["c"], file_bytes=sizes // 5 + 1)
    counts = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert len(counts) == 5 and max(counts) < 8_000
    assert tuple(table_metrics(many.where("v = 1 AND v = 2")).first()) == (0, 0, 0)


def test_z_order_narrows_every_column(spark, tmp_path):
    """Files of a table clustered by two columns hold a fraction of the range of each."""
    rows = spark.range(0, 40_000, 1, 8).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("x"),
        F.concat(F.lit("k"), F.lpad(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).cast("string"), 4, "0")).alias("y"),
        F.when(F.col("id") % 2 == 0, F.lit(datetime(2024, 1, 1))).cast("timestamp_ntz").alias("at"),
    )
    rows.write.parquet(str(tmp_path / "in"))
    stored = spark.read.parquet(str(tmp_path / "in"))
    size = table_metrics(stored).first()["size_in_bytes"]
    out = compact(stored, size, ["x", "y"], file_bytes=size // 16 + 1)
    spans = out.groupBy(F.spark_partition_id()).agg(
        (F.max("x") - F.min("x")).alias("dx"),
        (F.substring(F.max("y"), 2, 4).cast("int") - F.substring(F.min("y"), 2, 4).cast("int")).alias("dy"),
    ).agg(F.avg("dx"), F.avg("dy")).first()
    assert spans[0] < 550 and spans[1] < 550
    assert out.columns == ["x", "y", "at"] and out.exceptAll(stored).isEmpty() and out.count() == 40_000
    assert compact(stored, size, ["at", "x", "y"], "at").count() == 40_000


def test_control_rows(spark):
    rows = spark.createDataFrame(
        [("a", control.NEVER_LOADED, 1, None, "keep"), ("b", "2024-01-01T00:00:00", 2, "2023", "keep")],
        "name STRING, last_modified STRING, row_count BIGINT, created_at STRING, path STRING",
    )
    assert control.read_control(rows, "a")["first_load"] is True
    assert control.read_control(rows, "b")["first_load"] is False
    assert "first_load" not in control.read_control(rows.drop("last_modified"), "a")
    with pytest.raises(LookupError):
        control.read_control(rows, "c")
    loads = spark.createDataFrame(
        [("a", "2024-02-02", 10), ("b", "2024-02-02", 20), ("c", "2024-02-02", 30)],
        "name STRING, last_modified STRING, row_count BIGINT",
    )
    found = sorted(tuple(r) for r in control.advance(rows, loads).collect())
    assert found == [
        ("a", "2024-02-02", 10, "2024-02-02", "keep"),
        ("b", "2024-02-02", 20, "2023", "keep"),
        ("c", "2024-02-02", 30, "2024-02-02", None),
    ]


def test_changes_between_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for version, rows in ((0, [(1, "a"), (2, "b")]), (1, [(1, "a"), (2, "c"), (3, "d")])):
        spark.createDataFrame(rows, "id INT, v STRING").write.parquet(version_path(path, version))
    assert read_changes(spark, path, 1, True, "id").count() == 3
    assert read_changes(spark, path, 0, False, "id").columns == ["id", "v"]
    changed = sorted(tuple(r) for r in read_changes(spark, path, 1, False, "id").collect())
    assert changed == [(2, "c", "update_postimage"), (3, "d", "insert")]
    assert feed_options(3, False) == {"readChangeFeed": "true", "startingVersion": "2", "endingVersion": "3"}
    assert feed_options(0, False) == {} == feed_options(3, True)


def test_scratch_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or scratch_dir(spark).startswith(shared)
    rows = spark.range(5)
    assert written_out(rows).count() == 5
    assert cut_lineage(rows).count() == 5


def test_scratch_without_a_shared_folder():
    """A local session gets a temporary folder, a cluster session an error."""

    def session(master, shared=None):
        conf = SimpleNamespace(get=lambda name, default: shared or default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert os.path.isdir(scratch_dir(session("local[4]")))
    assert scratch_dir(session("yarn", "hdfs:///tmp/x/")).startswith("hdfs:///tmp/x/sluicework-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn"))


def test_merge_into_catalog_table(monkeypatch):
    """The native merge gets the conditions of each mode."""
    calls = []

    class Merge:
        def __getattr__(self, name):
            return lambda *args: calls.append((name, bool(args))) or self

    class Source:
        def alias(self, name):
            return self

        def mergeInto(self, table, condition):
            calls.append((table, True))
            return Merge()

    monkeypatch.setattr(sinks.F, "col", Comparable)
    for inc, insert_only, middle in ((None, False, ("whenMatched", False)), ("inc", False, ("whenMatched", True))):
        calls.clear()
        sinks.merge_into_table(Source(), "cat.t", "id", inc, insert_only)
        assert calls[0] == ("cat.t", True) and calls[1] == middle
        assert [c[0] for c in calls[2:]] == ["updateAll", "whenNotMatched", "insertAll", "withSchemaEvolution", "merge"]
    calls.clear()
    sinks.merge_into_table(Source(), "cat.t", "id", "inc", insert_only=True)
    assert [c[0] for c in calls[1:]] == ["whenNotMatched", "insertAll", "withSchemaEvolution", "merge"]


class Comparable:
    def __init__(self, name):
        self.name = name

    def __eq__(self, other):
        return f"{self.name} = {other.name}"

    def __gt__(self, other):
        return f"{self.name} > {other.name}"


def test_z_order_ranks_whole_texts(spark):
    """Names that differ only after a long common prefix still narrow to their files."""
    rows = spark.range(4000).select(
        F.format_string("Customer number %09d", F.pmod(F.xxhash64("id"), F.lit(10**9))).alias("name"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("n"),
    )
    laid = compact(rows, 16 * 1000, ["name", "n"], file_bytes=1000)
    ranges = laid.groupBy(F.spark_partition_id()).agg(F.min("name").alias("low"), F.max("name").alias("high")).collect()
    spans = [int(r.high[-9:]) - int(r.low[-9:]) for r in ranges]
    assert len(spans) == 16 and sum(spans) / len(spans) < 0.5 * 10**9
    assert laid.count() == 4000


def test_z_order_of_nulls_and_more_files_than_places(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("a"), F.lit(None).cast("string").alias("b"))
    laid = compact(rows, 3000, ["a", "b"], file_bytes=6)
    assert laid.exceptAll(rows).isEmpty() and laid.count() == 3000
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 400


def test_idle_scan_without_a_schema_has_no_rows(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([(1, "a")], "id INT, v STRING").write.json(path)
    idle = read_files(spark, path, "2100-01-01T00:00:00", "json", "kafka")
    assert idle.columns == ["id", "v"] and idle.collect() == []


def test_watermark_ignores_the_session_zone(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([(1,)], "id INT").write.json(path)
    zone = spark.conf.get("spark.sql.session.timeZone")
    just_before = datetime.fromtimestamp(os.stat(path).st_mtime - 3600, tz=timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert read_files(spark, path, just_before, "json", "kafka", "id INT").count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
