import random

import pytest

from sluicework.llm import merkle
from sluicework.llm.merkle import audit, warc_layout

SCHEMA = "file string, offset long, record binary"


def _found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _replica(n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for name, share in (("a", 0.7), ("b", 0.2), ("c", 0.1)):
        at = 0
        for _ in range(int(n * share)):
            record = rng.randbytes(rng.randrange(1, 90))
            rows.append((name, at, record))
            at += len(record)
    return rows


@pytest.mark.parametrize("span, fan", [(64, 2), (1 << 18, 16)])
def test_damage_is_located(spark, monkeypatch, span, fan):
    monkeypatch.setattr(merkle, "SPAN", span)
    monkeypatch.setattr(merkle, "FAN", fan)
    good = _replica()
    bad, expected = list(good), []
    for at in (0, 7, 150, 299):
        name, offset, record = good[at]
        bad[at] = (name, offset, bytes([record[0] ^ 1]) + record[1:])
        expected.append((name, offset, len(record), len(record), "changed"))
    name, offset, record = good[210]
    bad[210] = (name, offset, record[:-1])
    expected.append((name, offset, len(record), len(record) - 1, "changed"))
    bad += [("d", 5, b"new"), (*good[3][:2], good[3][2])]
    expected += [("d", 5, None, 3, "extra"), (*good[3][:2], len(good[3][2]), 2 * len(good[3][2]), "changed")]
    name, offset, record = bad.pop(100)
    expected.append((name, offset, len(record), None, "missing"))
    a, b = spark.createDataFrame(good, SCHEMA), spark.createDataFrame(bad, SCHEMA)
    found = audit(a.selectExpr("*", "1 AS node", "2 AS digest"), b)
    assert _found(found) == sorted(expected, key=str)


def test_equal_replicas_and_empty_tables(spark):
    rows = spark.createDataFrame([*_replica(50), *_replica(50)[:9]], SCHEMA)
    none = spark.createDataFrame([], SCHEMA)
    assert audit(rows, rows.orderBy("record")).collect() == [] == audit(none, none).collect()
    assert {r.problem for r in audit(rows, none).collect()} == {"missing"}


def test_nulls(spark):
    a = spark.createDataFrame([(None, None, None), ("f", 0, None), ("f", 9, b"x")], SCHEMA)
    b = spark.createDataFrame([(None, None, None), ("f", 0, b""), ("f", None, b"x")], SCHEMA)
    assert _found(audit(a, b)) == sorted([("f", 0, -1, 0, "changed"), ("f", 9, 1, None, "missing"), ("f", -1, None, 1, "extra")], key=str)


def test_layout_has_no_gaps(spark):
    rows = [(i, f"http://x/{i}", "h" * (i * 37 % 500)) for i in range(60)] + [(None, None, None), (3, "http://x/3", "again"), (4, "u", "é" * 10**5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS file", "2 AS record", "3 AS offset")
    by_file = {}
    for r in warc_layout(pages, 4).collect():
        by_file.setdefault(r.file, []).append((r.offset, bytes(r.record)))
    assert sum(map(len, by_file.values())) == len(rows)
    for own in by_file.values():
        end = 0
        for offset, record in sorted(own):
            assert offset == end and record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            head, body = record.split(b"\r\n\r\n", 1)
            assert int(head.rsplit(b": ", 1)[1]) == len(body) - 4
            end += len(record)
