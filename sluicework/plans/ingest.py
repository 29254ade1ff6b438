"""Collections to raw files, raw files to staging."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from sluicework.operators.schema import rename_duplicate_columns
from sluicework.sources.control import NEVER_LOADED
from sluicework.sources.files import read_files
from sluicework.sources.sinks import (
    INGEST_COLUMNS,
    with_ingest_columns,
    write_sized,
    write_staging,
)


def raw_path(root: str, source: str, database: str, collection: str) -> str:
    return "/".join([root.rstrip("/"), "raw", source, database.lower(), collection.lower()])


def ingest(
    df: DataFrame,
    path: str,
    ingested_at: Column | datetime,
    file_format: str = "json",
    **options: str,
) -> int:
    """Append any scan to raw files partitioned by the hour of ingestion; returns the rows.

    One time for all rows needs no shuffle.  A time per row brings the rows of
    an hour together first, or every task would write a file for every hour.
    """
    rows = with_ingest_columns(df, ingested_at)
    if isinstance(ingested_at, Column):
        rows = rows.hint("rebalance", *INGEST_COLUMNS)
    return write_sized(
        rows, path, file_format=file_format, partition_by=INGEST_COLUMNS, **options
    )


def stage(
    spark: SparkSession,
    src_path: str,
    final_path: str,
    modified_after: str | None,
    file_format: str,
    day: str | None = None,
    **scan,
) -> int:
    """Append the rows of changed files to staging, names repaired; returns the rows.

    Staged sources have no envelope.
    """
    raw = read_files(spark, src_path, modified_after, file_format, "kafka", **scan)
    first_load = modified_after is None or modified_after == NEVER_LOADED
    return write_staging(rename_duplicate_columns(raw), final_path, day, first_load)
