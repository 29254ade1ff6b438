"""Queries against their SQL on tables whose values or sizes the small ones lack."""

from datetime import datetime

import __spark_entry__ as entry_module
from sluicework.llm import sentence_spans
from sluicework.operators.layout import TARGET_FILE_BYTES, compact
from sluicework.operators.merge import merge_with_changes
from sluicework.sources.scratch import session_conf
from sluicework.sources.tables import compact_small_files, create_table, merge_table, read_table
from tests import oracle

QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()


def mismatch(spark, name, folder):
    return oracle.mismatch(QUERIES[name](spark, str(folder)), oracle.connect(str(folder)), SQL[name])


def stored(rows, folder, name):
    rows.coalesce(1).write.parquet(f"{folder}/parts-{name}")
    next(folder.glob(f"parts-{name}/*.parquet")).rename(folder / f"{name}.parquet")


def test_epoch_to_ist_of_large_ids(spark, tmp_path):
    ids = [0, 999, 1000, 1499, 10**12 + 1, -1, None]
    at = datetime(2024, 1, 1, 0, 0, 59, 900_000)
    rows = [(n, at, user, "view", 1.0, "{}") for n, user in enumerate(ids)]
    types = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    stored(spark.createDataFrame(rows, types), tmp_path, "events")
    assert mismatch(spark, "epoch_to_ist", tmp_path) is None


def test_merge_with_changes_computes_its_rows_once(shuffled):
    """An array made row by row was computed a second time to see whether it was empty, and outside generated code."""
    stored = shuffled.range(1000).selectExpr("id", "id % 7 AS n", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS at")
    batch = shuffled.range(500, 1500).selectExpr("id", "id % 5 AS n", "TIMESTAMP_NTZ '2024-01-02 00:00:00' AS at")
    merged = merge_with_changes(stored, batch, "id", "at")
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "size(" not in plan
    assert plan.count("update_postimage") == 1
    found = {(r[0], r[1]): r[2] for r in merged.groupBy("_output", "_change_type").count().collect()}
    assert found == {("state", None): 1500, ("changes", "insert"): 500, ("changes", "update_preimage"): 500, ("changes", "update_postimage"): 500}


def test_repeated_spans_free_each_shuffle_as_it_ends(spark, monkeypatch):
    freed = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(freed, None)
    seen = []
    for name in ("packed_out", "written_out"):
        plain = getattr(sentence_spans, name)
        monkeypatch.setattr(sentence_spans, name, lambda df, plain=plain: (seen.append(spark.conf.get(freed, None)), plain(df))[1])
    text = "One two three four five six seven eight nine ten. Now eleven more words make it long enough to be a passage."
    documents = spark.createDataFrame([(1, text), (2, text)], "doc_id BIGINT, text STRING")
    rows = {r["doc_id"]: r["text"] for r in sentence_spans.remove_repeated_spans(documents).collect()}
    assert rows == {1: text, 2: ""}
    assert seen == ["true"] * 4
    assert spark.conf.get(freed, None) == before


def test_compacted_tasks_do_not_grow_with_the_table(spark):
    rows = spark.range(2000).selectExpr("id", "id % 7 AS n")
    size = 6 * TARGET_FILE_BYTES
    assert compact(rows, size, ["n"], file_bytes=size // 4 + 1).rdd.getNumPartitions() == 6
    assert compact(rows, size, ["n"], file_bytes=size // 9).rdd.getNumPartitions() == 10


def test_first_state_has_whole_files(spark, tmp_path):
    """Rows of a partition beyond what Spark gives a task made small files, which compaction had to rewrite."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(0, 400_000, 1, 4).selectExpr("id", "xxhash64(id) AS n", "'p' AS p")
    with session_conf(spark, key, "200k"):
        create_table(rows, str(tmp_path / "t"), "p")
        merge_table(spark, str(tmp_path / "t"), rows.selectExpr("-id - 1 AS id", "n", "'q' AS p"), "id", "p", 1)
        assert spark.conf.get(key) == "200k"
    assert len(read_table(spark, str(tmp_path / "t")).inputFiles()) == 2
    assert compact_small_files(spark, str(tmp_path / "t"), "p") == []
    assert read_table(spark, str(tmp_path / "t")).count() == 800_000
