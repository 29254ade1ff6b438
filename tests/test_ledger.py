"""Files by ledger, control rows by log."""

import os
import time

from sluicework.sources import control
from sluicework.sources.files import listed_files, read_files
from sluicework.sources.ledger import consume, next_watermark, read_ledger, read_unseen, unseen_files

KIND = "id INT, v STRING"


def drop(spark, path, *rows, at=None):
    spark.createDataFrame(list(rows), KIND).coalesce(1).write.mode("append").json(path)
    if at is not None:
        newest = max((os.path.join(path, f) for f in os.listdir(path) if f.endswith(".json")), key=os.path.getmtime)
        os.utime(newest, (at, at))


def load(spark, path, ledger, name):
    files = unseen_files(spark, path, ledger, name)
    found = sorted(r.id for r in read_unseen(spark, files, "json", KIND, "kafka").collect())
    consume(files, ledger, name)
    return found


def test_late_equal_and_changed_files(spark, tmp_path):
    path, ledger, now = str(tmp_path / "raw"), str(tmp_path / "ledger"), int(time.time())
    drop(spark, path, (1, "a"), at=now - 100)
    assert load(spark, path, ledger, "1") == [1]
    drop(spark, path, (2, "old"), at=now - 1000)
    drop(spark, path, (3, "same time"), at=now - 100)
    assert load(spark, path, ledger, "2") == [2, 3]
    # The same load again reads and records the same files.
    assert load(spark, path, ledger, "2") == [2, 3]
    assert load(spark, path, ledger, "3") == [] and read_ledger(spark, ledger).count() == 3
    (first,) = [r.path for r in listed_files(spark, path).collect() if "1" in open(r.path.removeprefix("file:")).read().split(",")[0]]
    os.utime(first.removeprefix("file:"), (now, now))
    assert load(spark, path, ledger, "4") == [1]


def test_watermark_comes_from_the_files(spark, tmp_path):
    path, now = str(tmp_path / "raw"), 1_700_000_000
    drop(spark, path, (1, "a"), at=now)
    assert next_watermark(listed_files(spark, path)) == "2023-11-14T22:13:20"
    assert next_watermark(listed_files(spark, path).where("false")) is None


def test_idle_scan_opens_one_file(spark, tmp_path):
    path = str(tmp_path / "raw")
    drop(spark, path, (1, "a"), at=1_700_000_000)
    with open(os.path.join(path, "broken.json"), "w") as file:
        file.write("no json at all")
    os.utime(os.path.join(path, "broken.json"), (1_600_000_000, 1_600_000_000))
    idle = read_files(spark, path, "2100-01-01T00:00:00", "json", "kafka", mode="FAILFAST")
    assert idle.columns == ["id", "v"] and idle.collect() == []


def test_log_of_control_rows(spark, tmp_path):
    log = str(tmp_path / "log")

    def append(load, *rows, kind="name STRING, version BIGINT, n BIGINT, path STRING"):
        control.append_load(spark.createDataFrame(list(rows), kind), log, load)

    append("0", ("a", 0, 1, "/a"), ("b", 0, 1, "/b"))
    append("a-1", ("a", 1, 5, None))
    append("b-1", ("b", 1, 7, None))
    append("a-1", ("a", 1, 5, None))
    append("a-2", ("a", 2, "now"), kind="name STRING, version BIGINT, last_modified STRING")
    found = {r.name: (r.version, r.n, r.path, r.last_modified) for r in control.read_log(spark, log).collect()}
    assert found == {"a": (2, 5, "/a", "now"), "b": (1, 7, "/b", None)}
    assert control.latest_version(spark, log, "a") == 2 and control.latest_version(spark, log, "z") is None
