"""SQL assembly over named sources, and back-fill of partial rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.operators.schema import column, quoted, remove_duplicate_columns
from sluicework.operators.skew import any_null, is_broadcastable, lookup_join


@contextmanager
def named_views(spark: SparkSession, frames: Mapping[str, DataFrame]) -> Iterator[None]:
    """Views for user SQL; a plan made inside keeps working after they are gone."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in frames:
            spark.catalog.dropTempView(name)


def run_sql(spark: SparkSession, frames: Mapping[str, DataFrame], query: str) -> DataFrame:
    """User SQL over named DataFrames."""
    with named_views(spark, frames):
        return spark.sql(query)


def assemble(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    fields: Sequence[str],
    unique_id: str,
    id_sql: str,
    incremental_key: str,
    incremental_sql: str,
    partition_column: str,
    partition_sql: str,
    from_sql: str,
) -> DataFrame:
    """Distinct curated rows: key, fields, incremental key and partition column.

    Key parts and the FROM clause are SQL over the named frames.  Where a field
    repeats a name, the later column stays.
    """
    chosen = [
        f"{id_sql} AS {quoted(unique_id)}",
        *[quoted(f) for f in fields if f != partition_column],
        f"{incremental_sql} AS {quoted(incremental_key)}",
        f"{partition_sql} AS {quoted(partition_column)}",
    ]
    rows = run_sql(spark, frames, f"SELECT {', '.join(chosen)} FROM {from_sql}")
    return remove_duplicate_columns(rows.distinct())


def backfill(
    delta: DataFrame,
    full: DataFrame,
    unique_id: str,
    incremental_key: str,
    fields: Sequence[str],
    split_above: int | None = None,
) -> DataFrame:
    """Complete the nulls of new rows from the stored row of their key.

    The key and the incremental key always come from the new row.
    """
    fields = [f for f in dict.fromkeys(fields) if f not in (unique_id, incremental_key)]
    stored = full.select(
        column(unique_id), *[column(f).alias(f"__stored_{i}") for i, f in enumerate(fields)]
    ).where(~any_null([unique_id]))
    wanted = delta.select(column(unique_id))
    if is_broadcastable(wanted):
        # Find the few stored rows first, so that the stored table is not shuffled.
        stored = stored.join(wanted, unique_id, "left_semi")
    return lookup_join(delta, stored, unique_id, "left", split_above).select(
        column(unique_id),
        column(incremental_key),
        *[
            F.coalesce(column(f), F.col(f"__stored_{i}")).alias(f) for i, f in enumerate(fields)
        ],
    )
