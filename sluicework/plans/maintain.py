"""Upkeep of versioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from sluicework.operators.layout import TARGET_FILE_BYTES, compact, table_metrics
from sluicework.sources.versions import read_version, write_version


def optimise(
    spark: SparkSession,
    path: str,
    version: int,
    partition_column: str,
    cluster_by: Sequence[str] = (),
    file_bytes: int = TARGET_FILE_BYTES,
) -> dict[str, int]:
    """Rewrite a version to well-sized, clustered files as the next one; returns its metrics."""
    current = read_version(spark, path, version)
    size = table_metrics(current).first()["size_in_bytes"]
    rows = compact(current, size, cluster_by, partition_column, file_bytes)
    return write_version(rows, path, version + 1, partition_column, shuffle=False)
