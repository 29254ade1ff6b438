"""Blocks of queries beside every shard of an index, and the merge of what shards give."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Lists that a step of the merge puts together.
MERGE_FAN = 8

#: Blocks whose numbers (16 bytes each) are broadcast; more are joined.
BROADCAST_BLOCKS = 1_000_000


def numbered(blocks: DataFrame, count: int) -> DataFrame:
    """The ``count`` rows of ``blocks`` with ``number`` from 0 up, in the order of ``block``."""
    numbers = blocks.select("block", (F.row_number().over(Window.orderBy("block")) - 1).alias("number"))
    return blocks.join(F.broadcast(numbers) if count <= BROADCAST_BLOCKS else numbers, "block").drop("block")


def beside_shards(shards: DataFrame, queries: DataFrame) -> tuple[DataFrame, int]:
    """Every block of queries sent to every shard, and the number of shards.

    Both have a unique ``block`` and columns of their own. A task of the result holds one
    shard: first its row with ``part`` 0, then the blocks of queries.
    """
    shard_count, query_count = shards.count(), queries.count()
    own = numbered(shards, shard_count).withColumnRenamed("number", "shard").withColumn("part", F.lit(0))
    parts = numbered(queries, query_count).withColumn("part", F.col("number") + 1).drop("number")
    sent = own.select("shard", F.explode(F.sequence(F.lit(1), F.lit(query_count))).alias("part")) if query_count else own.select("shard", "part").limit(0)
    both = own.unionByName(sent.join(parts, "part"), allowMissingColumns=True)
    return both.repartitionById(max(1, shard_count), F.col("shard")).sortWithinPartitions("shard", "part"), shard_count


def merged(lists: DataFrame, keys: list[str], shards: int, k: int) -> DataFrame:
    """``keys`` and the ``k`` least elements of all arrays ``best``, merged up a tree of shards."""
    while True:
        lists = (
            lists.withColumn("shard", F.floor(F.col("shard") / MERGE_FAN))
            .groupBy(*keys, "shard")
            .agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
        )
        shards = math.ceil(shards / MERGE_FAN)
        if shards <= 1:
            return lists.drop("shard")
