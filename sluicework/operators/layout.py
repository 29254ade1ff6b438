"""Table layout: compaction, clustering, metrics, lineage."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from sluicework.operators.schema import column
from sluicework.operators.skew import row_salt

# Fixed value: bytes a compacted file should hold.
TARGET_FILE_BYTES = 104_857_600

# A task sorts and writes a file alone: rows of larger ones would fill its memory.
MOST_FILE_BYTES = TARGET_FILE_BYTES

_TIE = "__tie"
_PLACE = "__place"
_LEAST_BITS = 4
_EXTRA_BITS = 2
_SAMPLED_PER_BOUND = 16
_SAMPLE_SEED = 7


def file_sizes(df: DataFrame) -> DataFrame:
    """One row per file a scan reads rows from, with rows and bytes."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_bytes"),
    ).agg(F.count(F.lit(1)).alias("rows"))


def table_metrics(df: DataFrame) -> DataFrame:
    """Rows, files and bytes of a file scan; files without rows are not seen."""
    return file_sizes(df).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("num_files"),
        F.coalesce(F.sum("file_bytes"), F.lit(0)).alias("size_in_bytes"),
    )


def compact(
    df: DataFrame,
    table_bytes: int,
    cluster_by: Sequence[str] = (),
    partition_column: str | None = None,
    file_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Repartition a table of known size to files of about ``file_bytes``.

    With ``cluster_by``, files hold rows that are close in all of these columns:
    by value for one, along a Z-order curve for several.  Rows of a partition
    value stay together.  A range may end inside equal values, so a value that
    fills many files is split over as many tasks.  Such files are sorted and so
    hold ``MOST_FILE_BYTES`` at most; larger tables get more files, not larger tasks.
    """
    files = max(1, -(-table_bytes // file_bytes))
    first = [column(partition_column)] if partition_column else []
    if not first and not cluster_by:
        return df.repartition(files)
    files = max(files, -(-table_bytes // MOST_FILE_BYTES))
    place = [column(c) for c in cluster_by]
    if len(place) > 1:
        df = with_z_order(df, cluster_by, files)
        place = [F.col(_PLACE)]
    return (
        df.withColumn(_TIE, row_salt(df, 2**31 - 1))
        .repartitionByRange(files, *first, *place, F.col(_TIE))
        .sortWithinPartitions(*first, *place)
        .drop(_TIE, _PLACE)
    )


def with_z_order(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """Add the place of each row on a Z-order curve: interleaved bits of ranks.

    A rank is the number of quantile bounds of the column that are not above the
    value, whole values of any ordered type; nulls are least.  The bits of a rank
    follow from the number of files.  One job over the columns samples the bounds.
    """
    bits = min(62 // len(columns), max(_LEAST_BITS, math.ceil(math.log2(files) / len(columns)) + _EXTRA_BITS))
    chosen = [column(c) for c in columns]
    sample = df.select(*chosen).orderBy(F.rand(_SAMPLE_SEED)).limit(_SAMPLED_PER_BOUND << bits).collect()
    place = F.lit(0).cast("bigint")
    ranks = [f"__rank_{i}" for i in range(len(columns))]
    for i, name in enumerate(columns):
        bounds = _quantiles([row[i] for row in sample], (1 << bits) - 2)
        df = df.withColumn(ranks[i], _rank(column(name), bounds, df.schema[name].dataType))
        for bit in range(bits):
            one = F.shiftright(F.col(ranks[i]), bit).bitwiseAND(1)
            place = place + F.shiftleft(one, bit * len(columns) + i)
    return df.withColumn(_PLACE, place).drop(*ranks)


def _quantiles(values: list, count: int) -> list:
    """At most ``count`` different values that split the known ones evenly."""
    known = sorted(v for v in values if v is not None and v == v)
    if not known:
        return []
    return sorted({known[(i + 1) * len(known) // (count + 1)] for i in range(min(count, len(known) - 1))})


def _rank(value: Column, bounds: list, kind: DataType) -> Column:
    """1 and the bounds that are not above a value, found in two steps; 0 of null."""

    def up_to(some: Column) -> Column:
        return F.size(F.filter(some, lambda bound: bound <= value))

    def literals(some: list) -> Column:
        return F.array(*[F.lit(v).cast(kind) for v in some])

    rank = F.lit(0)
    if bounds:
        width = math.isqrt(len(bounds) - 1) + 1
        parts = [bounds[at : at + width] for at in range(0, len(bounds), width)]
        part = up_to(literals([p[0] for p in parts]))
        within = up_to(F.element_at(F.array(*map(literals, parts)), F.greatest(part, F.lit(1))))
        rank = F.when(part > 0, (part - 1) * width + within).otherwise(0)
    return F.when(value.isNull(), 0).otherwise(rank + 1).cast("bigint")


def cut_lineage(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """The same rows, kept as reliable checkpoint files in the session's folder."""
    spark = spark or df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        from sluicework.sources.scratch import scratch_dir

        spark.sparkContext.setCheckpointDir(scratch_dir(spark))
    return df.checkpoint()
