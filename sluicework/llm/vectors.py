"""Vectors in blocks, and blocks of queries beside every shard of vectors.

A shard is a block of rows that a task holds in memory; queries are smaller blocks,
sent to every shard and read one after the other. So a query set is held against all
rows with no more in memory than a shard and a block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm import shards as shard_module
from sluicework.llm.shards import beside_shards
from sluicework.llm.tasks import map_arrow
from sluicework.sources.scratch import written_out

#: Rows of a shard and of a block of queries, and bytes of their vectors: whichever ends first.
SHARD_ROWS = 16_384
SHARD_BYTES = 16 << 20
QUERY_ROWS = 1_024
QUERY_BYTES = 1 << 20

_NUMBER_BYTES = 8


@dataclass(frozen=True)
class Block:
    """Ids and vectors of equal dimension, by row."""

    ids: np.ndarray
    vectors: np.ndarray


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``vector`` as doubles, of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & (F.size(vector) > 0) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")
    )


def _packed(most_rows: int, most_bytes: int):
    def block(dim: int, parts: list) -> pa.RecordBatch:
        ids, data = (np.concatenate(p) for p in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([ids.tobytes()]), pa.array([data.tobytes()])], ["dim", "ids", "data"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        for batch in batches:
            column = batch.column("vector")
            flat = np.asarray(column.flatten())
            sizes = np.diff(np.asarray(column.offsets))
            ids, start = np.asarray(batch.column("vec_id")), np.cumsum(sizes) - sizes
            for dim in np.unique(sizes):
                of_dim = np.flatnonzero(sizes == dim)
                rows = max(1, min(most_rows, most_bytes // (_NUMBER_BYTES * int(dim))))
                for at in range(0, len(of_dim), rows):
                    chosen = of_dim[at : at + rows]
                    parts = waiting.setdefault(int(dim), [])
                    parts.append((ids[chosen], flat[start[chosen][:, None] + np.arange(dim)]))
                    if sum(len(p[0]) for p in parts) >= rows:
                        yield block(int(dim), waiting.pop(int(dim)))
        for dim, parts in waiting.items():
            yield block(dim, parts)

    return run


def blocks(rows: DataFrame, size: int, most_bytes: int) -> DataFrame:
    """``vec_id`` and ``vector`` rows dealt evenly into numbered blocks of one dimension."""
    found = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("vector").cast("long")).alias("numbers")).first()
    count = max(1, math.ceil(found["rows"] / size), math.ceil((found["numbers"] or 0) * _NUMBER_BYTES / most_bytes))
    packed = map_arrow(rows.repartition(count), _packed(size, most_bytes), "dim int, ids binary, data binary")
    return written_out(packed.withColumn("block", F.monotonically_increasing_id()))


def _opened(row: dict) -> Block:
    return Block(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["data"], np.float64).reshape(-1, row["dim"]))


def against_shards(
    vectors: DataFrame,
    is_query: Column,
    prepare: Callable[[Block], object],
    search: Callable[[object, Block], Iterator[tuple[int, list, list]]],
    score_type: str,
) -> tuple[DataFrame, int]:
    """The best of each shard for each query, and the number of shards.

    ``prepare`` makes of a shard what ``search`` needs; that yields of each query its id
    and its best ids and scores. Returns ``query_id``, ``shard`` and ``best``, an array of
    (``order``: the score with the sign turned, ``vec_id``) in ascending order.
    """
    shards = blocks(vectors, SHARD_ROWS, SHARD_BYTES)
    asked = vectors.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    both, count = beside_shards(shards, blocks(asked, QUERY_ROWS, QUERY_BYTES))
    both = both.select("shard", "part", "dim", "ids", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, dim, prepared = None, None, None
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if row["part"] == 0:
                    shard, dim, prepared = row["shard"], row["dim"], prepare(_opened(row))
                elif row["dim"] == dim and row["shard"] == shard:
                    found = list(search(prepared, _opened(row)))
                    yield pa.RecordBatch.from_pylist(
                        [
                            {
                                "query_id": query,
                                "shard": shard,
                                "best": [{"order": -s, "vec_id": i} for i, s in zip(ids, scores, strict=True)],
                            }
                            for query, ids, scores in found
                        ],
                        schema=pa.schema(
                            [
                                ("query_id", pa.int64()),
                                ("shard", pa.int64()),
                                ("best", pa.list_(pa.struct([("order", _ARROW[score_type]), ("vec_id", pa.int64())]))),
                            ]
                        ),
                    )

    schema = f"query_id long, shard long, best array<struct<order:{score_type},vec_id:bigint>>"
    return map_arrow(both, run, schema), count


_ARROW = {"double": pa.float64(), "bigint": pa.int64()}


def merged(lists: DataFrame, shards: int, k: int) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k best, merged up a tree of shards."""
    return shard_module.merged(lists, ["query_id"], shards, k).select("query_id", F.posexplode("best").alias("at", "found")).select(
        "query_id",
        (F.col("at") + 1).alias("rank"),
        F.col("found.vec_id").alias("vec_id"),
        (-F.col("found.order")).alias("score"),
    )


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[list, list]:
    """The k highest scores, ties by smaller id, by partial selection."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        chosen = np.flatnonzero(scores >= least)
        ids, scores = ids[chosen], scores[chosen]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order].tolist(), scores[order].tolist()
