"""File increments driven by a streaming checkpoint.

A batch load keeps a watermark of file times; the streaming file source keeps
the exact set of files it has read, so late or equal timestamps lose nothing.
Both queries run what is available and stop.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sluicework.operators.dedup import latest_per_key
from sluicework.operators.merge import merge_newer
from sluicework.operators.schema import rename_duplicate_columns
from sluicework.sources.scratch import written_out
from sluicework.sources.sinks import STAGING_ROWS_PER_FILE, write_partitioned
from sluicework.sources.tables import create_table, has_table, merge_table
from sluicework.sources.versions import read_version, version_path


def file_stream(
    spark: SparkSession, path: str, file_format: str, schema: StructType | str
) -> DataFrame:
    reader = spark.readStream.format(file_format).option("recursiveFileLookup", "true")
    return reader.schema(schema).load(path)


def stream_staging(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append unseen files to gzip JSON staging, names repaired."""
    return (
        rename_duplicate_columns(stream)
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", STAGING_ROWS_PER_FILE)
        .option("compression", "gzip")
        .trigger(availableNow=True)
        .start()
    )


def stream_merge(
    stream: DataFrame,
    path: str,
    unique_id: str,
    incremental_key: str,
    partition_column: str,
    checkpoint: str,
) -> StreamingQuery:
    """Merge unseen files into a versioned table, one version per micro-batch.

    A batch always writes the version of its own number from the one before, so
    repeating it after a failure gives the same state.
    """
    return (
        stream.writeStream.foreachBatch(
            _merge_batch(path, unique_id, incremental_key, partition_column)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _merge_batch(
    path: str, unique_id: str, incremental_key: str, partition_column: str
) -> Callable[[DataFrame, int], None]:
    def merge(batch: DataFrame, batch_id: int) -> None:
        state = latest_per_key(batch, unique_id, incremental_key, ties="one")
        if batch_id > 0:
            newest = written_out(state)
            current = read_version(batch.sparkSession, path, batch_id - 1)
            state = merge_newer(current, newest, unique_id, incremental_key, unique_source=True)
        write_partitioned(
            state, version_path(path, batch_id), partition_column, shuffle=batch_id == 0
        )

    return merge


def stream_into_table(
    stream: DataFrame,
    path: str,
    unique_id: str,
    incremental_key: str,
    partition_column: str,
    checkpoint: str,
) -> StreamingQuery:
    """Merge unseen files into a table in place; only touched partitions are written.

    A micro-batch that is repeated after a failure finds its rows merged.  Its number names
    the rows it changed.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = latest_per_key(batch, unique_id, incremental_key, ties="one")
        if has_table(spark, path):
            merge_table(spark, path, newest, unique_id, partition_column, batch_id, incremental_key)
        else:
            create_table(newest, path, partition_column)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
