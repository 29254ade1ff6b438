"""Tables that loads change in place, partition by partition, with the rows each load changed.

A load first looks at the keys alone: which rows of the batch meet a stored row, and in
which partitions. Only those partitions are read and overwritten, by one job that writes
their new state and the changed rows side by side; new rows of other partitions are
appended. A load that failed may be repeated: what it had done is no change any more.

Below a table's folder are ``_output=state`` and ``_output=changes/_load=<number>``, each with
a folder per partition value, and ``_schema`` with the widest types of all loads.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sluicework.operators.evolve import conform, widened_type
from sluicework.operators.layout import TARGET_FILE_BYTES
from sluicework.operators.merge import (
    CHANGE_TYPE,
    CHANGES,
    INSERT,
    OUTPUT,
    STATE,
    merge_with_changes,
    net_changes,
)
from sluicework.operators.schema import column
from sluicework.operators.skew import any_null, bytes_conf, is_broadcastable, key_list, row_salt
from sluicework.sources.scratch import session_conf, written_out

LOAD = "_load"

# Bytes of shuffled rows that make a file of the target size; columnar files take less than half of them.
_FILE_SHUFFLE_BYTES = 3 * TARGET_FILE_BYTES
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

# A row that stands for a partition that has lost its last one.
_EMPTIED = "emptied"

_UPDATES = "__updates"
_KNOWN = "__known"
_OLD = "__old_partition"
_NEWEST = "__newest"
_COPIES = "__copies"


def _schema_path(path: str) -> str:
    return f"{path.rstrip('/')}/_schema"


def _keep_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    spark.createDataFrame([(schema.json(),)], "value STRING").coalesce(1).write.mode("overwrite").text(_schema_path(path))


def has_table(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.text(_schema_path(path)).isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def table_schema(spark: SparkSession, path: str) -> StructType:
    return StructType.fromJson(json.loads(spark.read.text(_schema_path(path)).first()[0]))


def _rows(spark: SparkSession, path: str, output: str) -> DataFrame:
    """All rows of one output, with ``_change_type`` and ``_load``."""
    kept = table_schema(spark, path)
    schema = StructType(
        kept.fields + [StructField(CHANGE_TYPE, StringType()), StructField(OUTPUT, StringType()), StructField(LOAD, LongType())]
    )
    reader = spark.read.schema(schema).option("basePath", path)
    try:
        found = reader.parquet(f"{path.rstrip('/')}/{OUTPUT}={output}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], schema)
    return found.select(*[column(f.name) for f in kept.fields], CHANGE_TYPE, LOAD)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows as of its last load."""
    return _rows(spark, path, STATE).where(F.col(CHANGE_TYPE).isNull()).drop(CHANGE_TYPE, LOAD)


def read_load_changes(
    spark: SparkSession, path: str, keys: str | Sequence[str], after: int, up_to: int
) -> DataFrame:
    """Rows changed by the loads after one and up to another, with ``_change_type``.

    Several loads are netted to the changes between the table before the first and after
    the last. No state is read.
    """
    changes = _rows(spark, path, CHANGES).where((F.col(LOAD) > after) & (F.col(LOAD) <= up_to)).drop(LOAD)
    return changes if up_to - after == 1 else net_changes(changes, keys)


def _write(rows: DataFrame, path: str, load: int, partition_column: str, mode: str) -> None:
    number = F.when(F.col(OUTPUT) == STATE, 0).otherwise(F.lit(load)).cast("bigint")
    (
        rows.withColumn(LOAD, number)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(OUTPUT, LOAD, partition_column)
        .parquet(path)
    )


def _whole_files(spark: SparkSession):
    """Within it, a rebalance splits a partition only where its files are full: what is below needs compaction at once."""
    return session_conf(spark, _ADVISORY, str(max(bytes_conf(spark, _ADVISORY), _FILE_SHUFFLE_BYTES)))


def create_table(state: DataFrame, path: str, partition_column: str, shuffle: bool = True) -> None:
    """The first state of a table; a state that is there already is replaced whole."""
    _keep_schema(state.sparkSession, path, state.schema)
    if shuffle:
        state = state.hint("rebalance", column(partition_column))
    with _whole_files(state.sparkSession):
        (
            state.select("*", F.lit(None).cast("string").alias(CHANGE_TYPE), F.lit(0).cast("bigint").alias(LOAD))
            .write.mode("overwrite")
            .option("compression", "snappy")
            .partitionBy(LOAD, partition_column)
            .parquet(f"{path.rstrip('/')}/{OUTPUT}={STATE}")
        )


def _among(partition: Column, values: Sequence) -> Column:
    known = [v for v in values if v is not None]
    found = partition.isin(known) if known else F.lit(False)
    return F.coalesce(found, F.lit(False)) | (partition.isNull() if None in values else F.lit(False))


def _hits(
    target: DataFrame, batch: DataFrame, keys: list[str], partition_column: str, incremental_key: str | None, insert_only: bool
) -> DataFrame:
    """Stored rows that the batch meets, by key: their partition, whether they are updated, and by how many rows."""
    newest = F.max(column(incremental_key)) if incremental_key else F.lit(None)
    asked = batch.where(~any_null(keys)).groupBy(*map(column, keys)).agg(newest.alias(_NEWEST), F.count(F.lit(1)).alias(_COPIES))
    stored = [column(incremental_key)] if incremental_key and incremental_key not in keys else []
    met = target.select(*map(column, keys), *stored, column(partition_column).alias(_OLD)).join(asked, keys)
    if insert_only:
        updates = F.lit(False)
    elif incremental_key is None:
        updates = F.lit(True)
    else:
        updates = F.coalesce(F.col(_NEWEST) > column(incremental_key), F.lit(False))
    return met.select(*map(column, keys), F.col(_OLD), updates.alias(_UPDATES), _COPIES)


def merge_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: str | Sequence[str],
    partition_column: str,
    load: int,
    incremental_key: str | None = None,
    insert_only: bool = False,
    fill_nulls: bool = False,
) -> list:
    """Merge a batch into a table; returns the values of the partitions that were overwritten.

    Rules are those of :func:`merge_newer`, of :func:`merge_always` without an
    incremental key, and of :func:`merge_insert`. Columns, inner fields and types evolve;
    partitions that are not touched keep their files and are read in the wider types.
    Rows may move between partitions. ``load`` names the changed rows for
    :func:`read_load_changes`; loads of one table must not run at once.
    """
    keys = key_list(keys)
    target = read_table(spark, path)
    batch = written_out(batch)
    if batch.isEmpty():
        return []
    schema = widened_type(target.schema, batch.schema)
    hits = written_out(_hits(target, batch, keys, partition_column, incremental_key, insert_only))
    marks = hits.groupBy(*map(column, keys)).agg(F.max(_UPDATES).alias(_UPDATES), F.lit(True).alias(_KNOWN))
    marked = written_out(batch.join(marks, keys, "left").select(*map(column, batch.columns), _UPDATES, _KNOWN))
    renewed = marked.where(_UPDATES).select(*map(column, keys), column(partition_column))
    old = hits.where(_UPDATES).select(*map(column, keys), _OLD)
    # One row per partition at most, as many as the table has folders.
    touched = [r[0] for r in old.select(_OLD).union(renewed.select(column(partition_column))).distinct().collect()]
    left = old.join(renewed, keys).where(~F.col(_OLD).eqNullSafe(column(partition_column))).select(_OLD).distinct().collect()
    _keep_schema(spark, path, schema)
    here = _among(column(partition_column), touched)
    is_new = F.col(_KNOWN).isNull()
    if touched:
        source = marked.where(F.coalesce(F.col(_UPDATES), F.lit(False)) | (is_new & here)).drop(_UPDATES, _KNOWN)
        # Else the merge looks at all rows of a key, and raises.
        unique = hits.where(F.col(_UPDATES) & (F.col(_COPIES) > 1)).isEmpty()
        merged = merge_with_changes(target.where(here), source, keys, incremental_key, unique_source=unique, fill_nulls=fill_nulls)
        if left:
            merged = merged.unionByName(_emptied(merged, partition_column, [r[0] for r in left]))
        if not is_broadcastable(source):
            # Rows came together by key; without this every task writes to every partition.
            merged = merged.hint("rebalance", OUTPUT, column(partition_column))
        _write(merged, path, load, partition_column, "overwrite")
    new = marked.where(is_new & ~here).drop(_UPDATES, _KNOWN)
    if not new.isEmpty():
        with _whole_files(spark):
            _write(_inserted(conform(new, schema)).hint("rebalance", OUTPUT, column(partition_column)), path, load, partition_column, "append")
    return touched


def _inserted(rows: DataFrame) -> DataFrame:
    """New rows as state and as change, once each."""
    kinds = F.array(
        F.struct(F.lit(None).cast("string").alias(CHANGE_TYPE), F.lit(STATE).alias(OUTPUT)),
        F.struct(F.lit(INSERT).alias(CHANGE_TYPE), F.lit(CHANGES).alias(OUTPUT)),
    )
    return rows.select("*", F.inline(kinds))


def _emptied(merged: DataFrame, partition_column: str, values: list) -> DataFrame:
    """A row for each partition that rows have left: it is overwritten even if none stay."""
    kind = merged.schema[partition_column].dataType
    rows = merged.sparkSession.createDataFrame([(v,) for v in values], StructType([StructField("value", kind)]))
    own = {partition_column: F.col("value"), CHANGE_TYPE: F.lit(_EMPTIED), OUTPUT: F.lit(STATE)}
    return rows.select(
        *[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in merged.schema.fields]
    )


def compact_small_files(
    spark: SparkSession,
    path: str,
    partition_column: str,
    file_bytes: int = TARGET_FILE_BYTES,
    least_small: int = 2,
) -> list:
    """Rewrite partitions that have collected small files; returns their values.

    Small is below half of ``file_bytes``.  Only partitions with at least ``least_small``
    such files are read and overwritten, with files of about ``file_bytes``; all others
    keep their files.  Found by file metadata alone.
    """
    state = _rows(spark, path, STATE)
    is_small = F.col("bytes") * 2 < file_bytes
    sizes = (
        state.select(column(partition_column), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .distinct()
        .groupBy(column(partition_column))
        .agg(F.count_if(is_small).alias("small"), F.greatest(F.lit(1), F.ceil(F.sum("bytes") / file_bytes)).cast("int").alias("files"))
        .where(F.col("small") >= least_small)
    )
    # One row per partition at most, as many as the table has folders.
    chosen = sizes.select(column(partition_column), "files").collect()
    if not chosen:
        return []
    values = [r[0] for r in chosen]
    files = F.coalesce(*[F.when(column(partition_column).eqNullSafe(F.lit(v)), n) for v, n in chosen], F.lit(1))
    rows = read_table(spark, path).where(_among(column(partition_column), values))
    bucket = F.pmod(row_salt(rows, 1 << 20), files)
    dealt = rows.repartition(sum(r[1] for r in chosen), column(partition_column), bucket)
    whole = dealt.withColumn(CHANGE_TYPE, F.lit(None).cast("string")).withColumn(OUTPUT, F.lit(STATE))
    _write(whole, path, 0, partition_column, "overwrite")
    return values
