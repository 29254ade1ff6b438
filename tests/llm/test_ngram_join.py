import random

import pytest

from sluicework.llm.components import connected_components
from sluicework.llm.ngram_join import ngram_jaccard_components
from tests.llm.helpers import DOCUMENT, documents, jaccard_components


def _text(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def _edited(rng, text, share):
    return " ".join(f"x{rng.randrange(10**9)}" if rng.random() < share else w for w in text.split())


def _corpus():
    rng = random.Random(5)
    rows, passage = [], _text(rng, 60)
    for group in range(12):
        original = _text(rng, rng.choice([8, 30, 120]))
        rows += [original] * rng.randrange(1, 4)
        rows += [_edited(rng, original, share) for share in (0.005, 0.01, 0.02, 0.03, 0.04) for _ in range(4)]
        rows += [f"{passage} {_text(rng, 15)}" for _ in range(3)]
    rows += ["", None, "  \n", "one two", "one two", "ONE Two", "one", "ab " * 50, "ab " * 60]
    return list(enumerate(rows))


def _found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_equals_all_pairs(spark):
    rows = _corpus()
    found = ngram_jaccard_components(documents(spark, rows))
    assert _found(found) == sorted(jaccard_components(rows), key=str)
    assert found.filter("is_first").count() == len({c for _, n, c in jaccard_components(rows)})


def test_many_orders_and_pivot_rounds(spark, monkeypatch):
    """No round of pivots: all links are found by the pairs across components."""
    monkeypatch.setattr("sluicework.llm.ngram_join.PIVOT_ROUNDS", 0)
    rows = _corpus()[:120]
    assert _found(ngram_jaccard_components(documents(spark, rows))) == sorted(jaccard_components(rows), key=str)


def test_joined_instead_of_broadcast(spark, monkeypatch):
    monkeypatch.setattr("sluicework.llm.ngram_join.BROADCAST_NODES", 0)
    rows = _corpus()[:80]
    assert _found(ngram_jaccard_components(documents(spark, rows))) == sorted(jaccard_components(rows), key=str)


def test_null_ids_repeated_rows_and_other_columns(spark):
    text = "a b c d e f g"
    rows = [(None, text), (4, text), (4, text), (None, "only here and nowhere else now"), (9, None), (9, None)]
    df = documents(spark, rows).selectExpr("*", "'x' AS token", "1 AS node", "2 AS n_shingles", "'y' AS text_key")
    assert _found(ngram_jaccard_components(df)) == sorted(
        [(None, 3, 4), (4, 3, 4), (4, 3, 4), (None, 2, None), (9, 0, 9), (9, 0, 9)], key=str
    )


def test_long_text(spark):
    rng = random.Random(1)
    long = _text(rng, 60_000, 10**6)
    rows = [(1, long), (2, long + " one more word"), (3, "x" * 300_000)]
    assert [c for _, _, c in _found(ngram_jaccard_components(documents(spark, rows)))] == [1, 1, 3]


def test_empty_table(spark):
    assert ngram_jaccard_components(spark.createDataFrame([], DOCUMENT)).collect() == []


@pytest.mark.parametrize("length", [1, 2, 17])
def test_chain_is_one_component(spark, length):
    nodes = spark.range(length + 2).withColumnRenamed("id", "node")
    links = spark.createDataFrame([(i + 1, i) for i in range(length)], "a long, b long")
    found = {r.node: r.component for r in connected_components(nodes, links).collect()}
    assert found == {i: 0 for i in range(length + 1)} | {length + 1: length + 1}
