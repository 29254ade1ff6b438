"""Approximate nearest neighbours by collision counting.

Every shard keeps, for each of some projections, its vectors in the order of their
projected values. A query opens a window round its own value in each order and widens all
of them step by step (virtual rehashing). A vector that lies in enough windows is a
candidate; widening ends with enough candidates, which are then verified by the exact
measure. Projections are the axes of random orthonormal bases: the values of one basis
hold the whole distance, so counts tell near from far better than independent ones do.

The measure is the inner product. Vectors get one more component that brings all to
the largest norm, and queries are scaled to it; the nearest in that space has the
largest inner product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.vectors import Block, against_shards, best_of, merged, usable

#: Projections, a count of which fits a byte.
PROJECTIONS = 255
SEED = 11

#: Windows that a candidate lies in, as a share of all.
COLLISIONS = 0.8

#: Candidates that end the widening, as a share of a shard and in multiples of k.
LEAST_SHARE = 0.03
LEAST_TIMES = 1.2

#: Factor of a step. Widening starts with the width that the median of so many rows of the
#: shard needs; steps are taken in groups, each group's steps twice as long.
STEP = 1.01
SAMPLED = 9
NARROWEST, WIDEST = 1e-3, 4.0
GROUP = 3

#: Queries whose windows are looked up together, and rows whose collisions are counted together.
QUERIES = 64
COUNTED = 2_048


def _axes(dim: int) -> np.ndarray:
    """Orthonormal bases side by side, as many as it takes."""
    rng = np.random.default_rng([SEED, dim])
    bases = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-PROJECTIONS // dim))]
    return np.concatenate(bases, axis=1)[:, :PROJECTIONS]


class CollisionIndex:
    """Sorted projections of the vectors of one shard."""

    def __init__(self, shard: Block, norm: float) -> None:
        self.shard, self.norm = shard, norm
        self._axes = _axes(shard.vectors.shape[1] + 1)
        rest = np.sqrt(np.maximum(norm**2 - np.square(shard.vectors).sum(1), 0))
        values = np.column_stack([shard.vectors, rest]) @ self._axes
        order = np.argsort(values, axis=0, kind="stable")
        self._values = np.ascontiguousarray(np.take_along_axis(values, order, 0).T)
        self._kind = np.uint16 if len(values) < 1 << 16 else np.uint32
        # Of each row its place in every order: it lies in a window if the place does.
        self._places = np.empty(self._values.shape, self._kind)
        np.put_along_axis(self._places, order.T, np.broadcast_to(np.arange(len(values), dtype=self._kind), self._places.shape), 1)
        self._least = int(np.ceil(COLLISIONS * PROJECTIONS))
        self._first = 0.0

    def _windows(self, at: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of the windows of each query, width and projection."""
        sides = ((-widths, "left"), (widths, "right"))
        low, high = (
            np.stack([np.searchsorted(v, x[:, None] + w, side) for v, x in zip(self._values, at.T, strict=True)], 2)
            for w, side in sides
        )
        return low.astype(self._kind), (high - low).astype(self._kind)

    def _colliding(self, low: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Rows in enough windows of one query. Places below a window's start wrap round to large ones."""
        counts = [
            ((self._places[:, at : at + COUNTED] - low[:, None]) < length[:, None]).view(np.uint8).sum(0, dtype=np.uint8)
            for at in range(0, len(self.shard.ids), COUNTED)
        ]
        return np.flatnonzero(np.concatenate(counts) >= self._least)

    def _start(self, enough: int) -> float:
        """The width that brings the median of some rows enough candidates."""
        if not self._first:
            rows = np.unique(np.linspace(0, len(self.shard.ids) - 1, SAMPLED).astype(int))
            vectors = self.shard.vectors[rows]
            at = self._projected(vectors[np.linalg.norm(vectors, axis=1) > 0])
            needed, smallest = [0], NARROWEST * self.norm
            for own in at:
                low, high = 0, int(np.log(WIDEST / NARROWEST) / np.log(STEP))
                while low < high:
                    middle = (low + high) // 2
                    starts, lengths = self._windows(own[None], np.array([smallest * STEP**middle]))
                    is_enough = len(self._colliding(starts[0, 0], lengths[0, 0])) >= enough
                    low, high = (low, middle) if is_enough else (middle + 1, high)
                needed.append(low)
            self._first = smallest * STEP ** float(np.median(needed[1:] or needed))
        return self._first

    def _projected(self, queries: np.ndarray) -> np.ndarray:
        return (queries * (self.norm / np.linalg.norm(queries, axis=1, keepdims=True))) @ self._axes[:-1]

    def candidates(self, queries: np.ndarray, k: int) -> Iterator[np.ndarray]:
        """Of each query the rows in enough windows: at least k and a share, or all."""
        count = len(self.shard.ids)
        enough = int(np.ceil(LEAST_TIMES * k + LEAST_SHARE * count))
        if count <= enough:
            yield from (np.arange(count) for _ in queries)
            return
        first = self._start(enough)
        at = self._projected(queries)
        for start in range(0, len(at), QUERIES):
            part = at[start : start + QUERIES]
            found: list[np.ndarray | None] = [None] * len(part)
            open_, step, stride = np.arange(len(part)), 0, 1
            while len(open_):
                widths = first * STEP ** (step + stride * np.arange(GROUP, dtype=float))
                low, length = self._windows(part[open_], widths)
                for query, starts, lengths in zip(open_.tolist(), low, length, strict=True):
                    for one, size in zip(starts, lengths, strict=True):
                        rows = self._colliding(one, size)
                        if len(rows) >= enough:
                            found[query] = rows
                            break
                open_ = np.array([q for q in open_.tolist() if found[q] is None], int)
                step, stride = step + stride * GROUP, 2 * stride
            yield from found

    def search(self, queries: Block, k: int) -> Iterator[tuple[int, list, list]]:
        for query, vector, rows in zip(queries.ids, queries.vectors, self.candidates(queries.vectors, k + 1), strict=True):
            rows = rows[self.shard.ids[rows] != query]
            yield int(query), *best_of(self.shard.ids[rows], self.shard.vectors[rows] @ vector, k)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """The ``k`` rows found with the largest inner product with each query.

    Needs ``vec_id`` and ``embedding``; other columns are ignored. Queries are the rows
    where ``is_query``, a condition on ``vec_id``, holds; candidates are all rows with
    another vec_id. Returns ``query_id``, ``rank``, ``vec_id``, ``score``: the inner
    product in double precision.

    Null vec_ids, and vectors that are null, empty, zero or hold a null or a number that
    is not finite, take no part; vectors of different dimension are not compared. Equal
    scores are ranked by vec_id, repeated rows are found once each, and a query that
    repeats is answered once. With few rows all are candidates. An empty table gives no
    rows.
    """
    rows = usable(vectors).filter(F.exists("vector", lambda x: x != 0))
    square = F.aggregate("vector", F.lit(0.0), lambda sum_, x: sum_ + x * x)
    norm = float(np.sqrt(rows.agg(F.max(square)).first()[0] or 1.0))
    lists, shards = against_shards(
        rows, is_query, lambda shard: CollisionIndex(shard, norm), lambda index, queries: index.search(queries, k), "double"
    )
    return merged(lists, shards, k)
