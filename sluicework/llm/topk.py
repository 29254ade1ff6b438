"""Exact top-k by tiled matrix products.

A tile is the product of a block of queries and a shard; the best of each query are
selected from it in part, and the lists of all shards are merged up a tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame

from sluicework.llm.vectors import Block, against_shards, best_of, merged, usable

#: Query rows of a product at a time, so that a tile stays small.
TILE_ROWS = 128

SCALE = 256
_LONG = np.iinfo(np.int64)


def _levels(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors)


def _exact_products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products; sums that no double or long holds exactly are summed as
    whole numbers of any size, and kept within the range of a long."""
    largest = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * queries.shape[1]
    if largest < 2.0**53:
        return (queries @ vectors.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    products = whole(queries) @ whole(vectors).T
    return np.clip(products, _LONG.min + 1, _LONG.max).astype(np.int64)


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """The ``k`` highest integer inner products of each query with all other rows.

    Needs ``vec_id`` and ``embedding``; other columns are ignored. Components x count as
    floor(256 * x), x in double precision. Queries are the rows where ``is_query``, a
    condition on ``vec_id``, holds. Returns ``query_id``, ``rank``, ``vec_id``, ``score``.

    Null vec_ids, and vectors that are null, empty or hold a null or a number that is
    not finite, take no part; vectors of different dimension are not compared. Equal
    scores are ranked by vec_id. Rows with the vec_id of a query are not its
    candidates; other repeated rows are found once each, and a query that repeats is
    answered once. A score beyond a long is the long's limit. An empty table gives no
    rows.
    """

    def search(shard: Block, queries: Block) -> Iterator[tuple[int, list, list]]:
        for at in range(0, len(queries.ids), TILE_ROWS):
            products = _exact_products(_levels(queries.vectors[at : at + TILE_ROWS]), shard.vectors)
            for query, scores in zip(queries.ids[at : at + TILE_ROWS], products, strict=True):
                own = shard.ids == query
                ids, scores = (shard.ids[~own], scores[~own]) if own.any() else (shard.ids, scores)
                yield int(query), *best_of(ids, scores, k)

    def prepare(shard: Block) -> Block:
        return Block(shard.ids, _levels(shard.vectors))

    rows = usable(vectors)
    lists, shards = against_shards(rows, is_query, prepare, search, "bigint")
    return merged(lists, shards, k)
