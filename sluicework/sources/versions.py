"""Tables kept as one complete snapshot per version.

A load writes a new version next to the one it reads and the control row then
names it, so a failed or repeated load leaves readers untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from sluicework.operators.layout import table_metrics
from sluicework.operators.merge import change_feed, drop_preimages
from sluicework.sources.files import read_snapshot
from sluicework.sources.sinks import write_partitioned

DELTA_FORMAT = "delta"


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/v{version}"


def read_version(
    spark: SparkSession, path: str, version: int, file_format: str = "parquet"
) -> DataFrame:
    return read_snapshot(spark, version_path(path, version), file_format)


def write_version(
    state: DataFrame,
    path: str,
    version: int,
    partition_column: str,
    shuffle: bool = True,
    file_format: str = "parquet",
) -> dict[str, int]:
    """Write one version of a table; returns its metrics as control columns."""
    spark, target = state.sparkSession, version_path(path, version)
    write_partitioned(state, target, partition_column, shuffle, file_format)
    found = table_metrics(read_snapshot(spark, target, file_format)).first()
    return {**found.asDict(), "version": version}


def read_changes(
    spark: SparkSession,
    path: str,
    version: int,
    first_load: bool,
    keys: str | Sequence[str],
    file_format: str = "parquet",
) -> DataFrame:
    """Whole table on a first load, else the rows the latest version changed.

    Changed rows carry ``_change_type``; rows before an update are left out.
    """
    if file_format == DELTA_FORMAT:
        reader = spark.read.format(DELTA_FORMAT).options(**feed_options(version, first_load))
        changes = reader.load(path)
        return changes if first_load or version == 0 else drop_preimages(changes)
    after = read_version(spark, path, version, file_format)
    if first_load or version == 0:
        return after
    before = read_version(spark, path, version - 1, file_format)
    return drop_preimages(change_feed(before, after, keys))


def feed_options(version: int, first_load: bool) -> dict[str, str]:
    """Options that ask a change-tracking source for the latest two versions."""
    if first_load or version == 0:
        return {}
    return {
        "readChangeFeed": "true",
        "startingVersion": str(version - 1),
        "endingVersion": str(version),
    }
