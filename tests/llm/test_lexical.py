import math
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluicework.llm import lexical as module
from sluicework.llm.lexical import Queries, StratifiedShard, build_index, ranked_search, search_index, term_counts
from tests.llm.helpers import DOCUMENT, documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEM = "item_id long, text string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=20):
    """Every item against every document, term by term."""
    texts = [(i, terms(t)) for i, t in docs if terms(t)]
    count, total = len(texts), sum(len(t) for _, t in texts)
    df = {}
    for _, t in texts:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    found = []
    for item, text in items:
        scored = []
        for doc_id, t in texts:
            m = 100 - 25 + (25 * len(t) * count) // total
            score = 0
            for term in terms(text):
                tf = t.count(term)
                if tf:
                    score += math.floor(1000 * math.log((2 * count + 2) / (2 * df[term] + 1))) * ((1000000000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=str)


def _rows(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def _corpus(count, seed=5):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    share = 1 / np.arange(1, 401)
    return [(i, " ".join(rng.choice(words, int(rng.integers(1, 200)), p=share / share.sum()))) for i in range(count)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZé9 _-.日\x00\x7f\n", max_size=40))
def test_terms(text):
    hashes, counts = term_counts(text.encode())
    expected = terms(text)
    assert len(hashes) == len(set(expected)) and sorted(counts) == sorted(expected.count(t) for t in set(expected))


@pytest.mark.parametrize("shard, queries, k", [(2_000_000, 256, 20), (700, 3, 5), (1, 1, 1)])
def test_equals_all_items_against_all_documents(spark, monkeypatch, shard, queries, k):
    monkeypatch.setattr(module, "SHARD_TERMS", shard)
    monkeypatch.setattr(module, "QUERY_ROWS", queries)
    docs = _corpus(150) + [
        (900, None), (901, ""), (902, "... !!"), (903, "Rare RARE, rare!"), (904, "rare"), (904, "rare"), (None, "rare"), (905, "w1 " * 20_000),
        (-7, "Ünï cödé rare Ü"), (906, "rare"),
    ]
    items = [(i, t[: 40 + i]) for i, t in docs[:30]] + [(50, "rare"), (51, "nowhere"), (52, None), (53, ""), (54, "rare rare W1 cödé"), (None, "rare w2"), (55, "w1")]
    df = documents(spark, docs).selectExpr("*", "1 AS tf", "2 AS block", "3 AS shard", "4 AS item_id")
    asked = spark.createDataFrame([*items, (50, "rare")], ITEM).selectExpr("*", "1 AS doc_id", "2 AS score")
    assert _rows(ranked_search(df, asked, k)) == plain(docs, items, k)


def test_items_that_share_an_id(spark):
    docs = _corpus(40)
    found = _rows(ranked_search(documents(spark, docs), spark.createDataFrame([(1, "w5"), (1, "w9 w3")], ITEM), 3))
    assert found == sorted(plain(docs, [(1, "w5")], 3) + plain(docs, [(1, "w9 w3")], 3), key=str)


def test_index_is_searched_again(spark):
    docs = _corpus(60)
    index = build_index(documents(spark, docs))
    for text in ("w1 w2", "w300 w17"):
        assert _rows(search_index(index, spark.createDataFrame([(1, text)], ITEM), 4)) == plain(docs, [(1, text)], 4)


def test_a_task_holds_one_shard(spark):
    """A task made three shards; each is written, and so read, apart from the others."""
    docs = spark.range(0, 3, 1, 1).selectExpr("id AS doc_id", f"repeat('w' || id || ' all ', {module.SHARD_TERMS // 2}) AS text")
    index = build_index(docs)
    (written,) = (pq.ParquetFile(f.removeprefix("file:")).metadata for f in index.inputFiles())
    assert [written.row_group(i).num_rows for i in range(written.num_row_groups)] == [1, 1, 1]
    found = search_index(index, spark.createDataFrame([(1, "w1 w2"), (2, "w0")], ITEM), 4).collect()
    assert sorted((r.item_id, r.rank, r.doc_id) for r in found) == [(1, 1, 1), (1, 2, 2), (2, 1, 0)]


def test_strata_below_the_best_are_not_visited():
    """Rare terms of short documents; the long strata cannot reach them."""
    hashes, _ = term_counts(b"a")
    sizes = np.sort(np.random.default_rng(2).integers(1, 4000, 3000))
    row = {
        "doc_ids": list(range(3000)), "sizes": sizes, "terms": hashes, "df": np.array([3000]),
        "docs": np.arange(3000, dtype=np.int32), "tf": np.ones(3000, np.int32),
    }
    shard = StratifiedShard(row, 3000, int(sizes.sum()))
    queries = Queries(np.array([0]), [0], hashes, np.array([0, 1]), np.array([0]), np.array([7]))
    ((_, best),) = shard.search(queries, 20)
    assert [i for _, i in best] == list(range(20)) and shard.visited < len(shard.m) / 2


def test_empty_tables(spark):
    none, no_items = spark.createDataFrame([], DOCUMENT), spark.createDataFrame([], ITEM)
    assert ranked_search(none, spark.createDataFrame([(1, "a")], ITEM)).collect() == []
    assert ranked_search(documents(spark, [(1, "a")]), no_items).collect() == []
    assert ranked_search(none, no_items).collect() == []
