"""Sized, partitioned and merging writes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sluicework.operators.merge import merge_insert, merge_newer
from sluicework.operators.schema import column

# Rows per file of the two raw layers.
INGEST_ROWS_PER_FILE = 104_857
STAGING_ROWS_PER_FILE = 1_000_000

INGEST_COLUMNS = ("ingest_year", "ingest_month", "ingest_day", "ingest_hour")


def write_sized(
    df: DataFrame,
    path: str,
    mode: str = "append",
    file_format: str = "json",
    rows_per_file: int = INGEST_ROWS_PER_FILE,
    partition_by: Sequence[str] = (),
    **options: str,
) -> int:
    """Write files of at most ``rows_per_file`` rows; returns the rows.

    One pass: rows are counted as they are written.
    """
    counted = Observation()
    observed = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode).format(file_format).options(**options)
    writer = writer.option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    return counted.get.get("rows", 0)


def write_counted(
    df: DataFrame,
    path: str,
    mode: str = "append",
    file_format: str = "json",
    rows_per_file: int = INGEST_ROWS_PER_FILE,
) -> int:
    """Write exactly ``rows // rows_per_file + 1`` files, none when empty; returns the rows.

    Costs a count and a shuffle that evens out the files.
    """
    rows = df.count()
    if rows:
        files = rows // rows_per_file + 1
        df.repartition(files).write.mode(mode).format(file_format).save(path)
    return rows


def with_ingest_columns(df: DataFrame, ingested_at: Column | datetime) -> DataFrame:
    """Zero-padded year, month, day and hour of ingestion, to partition by."""
    at = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    patterns = ("yyyy", "MM", "dd", "HH")
    return df.select(
        "*",
        *[F.date_format(at, p).alias(c) for c, p in zip(INGEST_COLUMNS, patterns)],
    )


def write_staging(
    df: DataFrame, path: str, day: str | None = None, first_load: bool = False
) -> int:
    """Append gzip JSON to a dated folder; returns the rows.

    An increment is rebalanced, which makes few files of many small ones.  A
    first load is written from where it was read, without a shuffle.
    """
    day = day or datetime.now().strftime("%Y-%m-%d")
    return write_sized(
        df if first_load else df.hint("rebalance"),
        f"{path.rstrip('/')}/{day}/",
        rows_per_file=STAGING_ROWS_PER_FILE,
        compression="gzip",
    )


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_column: str,
    shuffle: bool = True,
    file_format: str = "parquet",
) -> None:
    """Overwrite a table with one directory per partition value.

    With ``shuffle``, rows move to one task per value, so that a directory gets
    one file; adaptive execution splits values too large for a task.
    """
    if shuffle:
        df = df.hint("rebalance", column(partition_column))
    (
        df.write.mode("overwrite")
        .option("compression", "snappy")
        .format(file_format)
        .partitionBy(partition_column)
        .save(path)
    )


# The names a caller of the load layer knows.
write = write_partitioned


def upsert(
    target: DataFrame, source: DataFrame, unique_id: str, incremental_key: str, **options
) -> DataFrame:
    return merge_newer(target, source, unique_id, incremental_key, **options)


def append(target: DataFrame, source: DataFrame, unique_id: str, **options) -> DataFrame:
    return merge_insert(target, source, unique_id, **options)


def merge_into_table(
    source: DataFrame,
    table: str,
    unique_id: str,
    incremental_key: str | None = None,
    insert_only: bool = False,
) -> None:
    """Merge in place, for catalog tables whose source supports row-level merges."""
    same_key = F.col(f"{table}.{unique_id}") == F.col(f"source.{unique_id}")
    merge = source.alias("source").mergeInto(table, same_key)
    if not insert_only and incremental_key is None:
        merge = merge.whenMatched().updateAll()
    elif not insert_only:
        newer = F.col(f"source.{incremental_key}") > F.col(f"{table}.{incremental_key}")
        merge = merge.whenMatched(newer).updateAll()
    merge.whenNotMatched().insertAll().withSchemaEvolution().merge()
