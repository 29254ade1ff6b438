"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluicework.operators.schema import column
from sluicework.operators.skew import (
    HASH,
    SALT,
    fan_out,
    heavy_hashes,
    is_large,
    is_orderable,
    key_hash,
    key_list,
    row_salt,
)

_RANK = "__rank"
_NEWEST = "__newest"


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    incremental_key: str,
    ties: str = "all",
    split_above: int | None = None,
) -> DataFrame:
    """Rows that carry the greatest incremental key of their key.

    Rows whose incremental key is null are dropped; null keys form one group.
    ``ties="all"`` keeps every row of the greatest value, ``ties="one"`` the
    first by the remaining columns.

    Ranking with a limit of one lets Spark cut each key to its local winners
    *before* the shuffle.  Only ties can still be many: for large input, the
    winners of heavy keys are found by aggregation and spread by a salt.  Small
    input drops undated rows last, so that an incremental key that is costly to
    compute is not computed for a pushed-down filter as well.
    """
    keys = key_list(keys)
    dated = column(incremental_key).isNotNull()
    newest_first = column(incremental_key).desc_nulls_last()
    first = (F.col(_RANK) == 1) & dated
    if ties == "one":
        others = [
            column(f.name)
            for f in df.schema.fields
            if f.name not in (*keys, incremental_key) and is_orderable(f.dataType)
        ]
        by_key = Window.partitionBy(*map(column, keys)).orderBy(newest_first, *others)
        return df.withColumn(_RANK, F.row_number().over(by_key)).where(first).drop(_RANK)
    if ties != "all":
        raise ValueError(f"ties must be 'all' or 'one', not {ties!r}")
    groups = list(map(column, keys))
    if is_large(df, split_above):
        df = _spread_heavy_winners(df.where(dated), keys, incremental_key)
        groups.append(F.col(SALT))
    by_key = Window.partitionBy(*groups).orderBy(newest_first)
    return df.withColumn(_RANK, F.rank().over(by_key)).where(first).drop(_RANK, SALT)


def _spread_heavy_winners(df: DataFrame, keys: list[str], incremental_key: str) -> DataFrame:
    """Reduce heavy keys to their winners in place and give these a salt."""
    digest = key_hash(keys, [df.schema[k].dataType for k in keys])
    renamed = [f"__heavy_{i}" for i in range(len(keys))]
    newest = (
        df.withColumn(HASH, digest)
        .join(F.broadcast(heavy_hashes(df, digest)), HASH, "left_semi")
        .groupBy(*map(column, keys))
        .agg(F.max(column(incremental_key)).alias(_NEWEST))
        .toDF(*renamed, _NEWEST)
    )
    same_key = [column(k).eqNullSafe(F.col(h)) for k, h in zip(keys, renamed)]
    spread = row_salt(df, fan_out(df.sparkSession))
    return (
        df.join(F.broadcast(newest), same_key, "left")
        .where(F.col(_NEWEST).isNull() | (column(incremental_key) == F.col(_NEWEST)))
        .withColumn(SALT, F.when(F.col(_NEWEST).isNotNull(), spread).otherwise(F.lit(0)))
        .drop(*renamed, _NEWEST)
    )
