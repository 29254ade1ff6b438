import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluicework.llm import token_rollups as rollups
from sluicework.sources.scratch import scratch_dir
from tests.llm.helpers import documents

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")
CHANGE = "source string, lang string, version string, tokens long, chars long, sign int"


@pytest.fixture
def path(spark):
    folder = scratch_dir(spark) + "/rollup"
    rollups.create(spark, folder)
    return folder


def _totals(spark, path):
    return {(r.source, r.lang, r.version): (r.documents, r.tokens, r.chars) for r in rollups.totals(spark, path).collect()}


def test_counts(spark):
    texts = [(1, "Some words, and 12 more."), (2, ""), (3, None), (None, "é " * 50_000)]
    df = documents(spark, texts).selectExpr("*", "1 AS tokens", "'x' AS version", "2 AS chars")
    plain = Tokenizer.from_file(WORDS)
    found = {r.doc_id: (r.tokens, r.chars, r.version) for r in rollups.count_tokens(df, WORDS, "w").collect()}
    assert found == {i: (len(plain.encode(t or "", add_special_tokens=False).ids), len(t or ""), "w") for i, t in texts}
    same = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {r.doc_id: r.tokens for r in rollups.count_tokens(df, BYTES, "b").collect()}
    assert found == {i: len(same.encode(t or "", add_special_tokens=False).ids) for i, t in texts}


def test_signed_batches_add_up(spark, path):
    def batch(*rows):
        return spark.createDataFrame(list(rows), CHANGE)

    assert rollups.commit(path, "1", batch(("s", "en", "v1", 10, 50, 1), ("s", "en", "v1", 7, 20, 1), (None, None, "v1", 3, 9, 1)))
    assert rollups.commit(path, "2", batch(("s", "en", "v1", 7, 20, -1), ("s", "en", "v2", 9, 20, 1), (None, None, "v1", 3, 9, -1)))
    expected = {("s", "en", "v1"): (1, 10, 50), ("s", "en", "v2"): (1, 9, 20)}
    assert _totals(spark, path) == expected
    assert not rollups.commit(path, "2", batch(("s", "en", "v1", 99, 99, 1)))
    rollups.create(spark, path)
    assert _totals(spark, path) == expected


def test_order_of_batches_does_not_matter(spark, path):
    rows = [("s", "en", "v", i, i, 1 if i % 3 else -1) for i in range(9)]
    for i in reversed(range(3)):
        rollups.commit(path, str(i), spark.createDataFrame(rows[3 * i : 3 * i + 3], CHANGE))
    assert _totals(spark, path) == {("s", "en", "v"): (3, sum(r[3] * r[5] for r in rows), sum(r[4] * r[5] for r in rows))}


def test_nulls_other_columns_and_empty(spark, path):
    rows = spark.createDataFrame([("s", None, None, None, 4, 1), ("s", None, None, 5, None, 1), ("s", None, None, 8, 8, None)], CHANGE)
    rollups.commit(path, "a", rows.selectExpr("*", "'z' AS batch", "7 AS documents"))
    assert _totals(spark, path) == {("s", None, None): (2, 5, 4)}
    assert rollups.commit(path, "b", spark.createDataFrame([], CHANGE))
    assert _totals(spark, path) == {("s", None, None): (2, 5, 4)}
