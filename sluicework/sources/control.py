"""Control rows: where a table lives and how far it was loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.operators.merge import merge_always
from sluicework.operators.schema import column

# Fixed value: the watermark of a table that was never loaded.
NEVER_LOADED = "2016-01-01T00:00:00"

LOAD = "load"

METRICS = ("row_count", "num_files", "size_in_bytes", "version")


def with_first_load(control: DataFrame) -> DataFrame:
    return control.withColumn("first_load", F.col("last_modified") == F.lit(NEVER_LOADED))


def read_control(control: DataFrame, name: str, database: str | None = None) -> dict:
    """The control row of a table, with ``first_load`` where it has a watermark."""
    rows = control.where(F.col("name") == name)
    if database is not None:
        rows = rows.where(F.col("database") == database)
    if "last_modified" in control.columns:
        rows = with_first_load(rows)
    row = rows.first()
    if row is None:
        raise LookupError(f"no control row for {name!r}")
    return row.asDict()


def advance(control: DataFrame, loads: DataFrame) -> DataFrame:
    """Control rows after loads: watermark and metrics move on.

    ``loads`` has ``name``, ``last_modified`` and any other columns to set.
    ``created_at`` is the load time of a first load and stays as it is after.
    """
    before = control.select(
        column("name"), *[column(c).alias(f"__{c}") for c in control.columns if c != "name"]
    )
    joined = loads.join(before, "name", "left")
    created = []
    if "created_at" in control.columns:
        first = F.coalesce(F.col("__last_modified") == NEVER_LOADED, F.lit(True))
        kind = control.schema["created_at"].dataType
        loaded_at = F.col("last_modified").cast(kind)
        created = [F.when(first, loaded_at).otherwise(F.col("__created_at")).alias("created_at")]
    updates = joined.select(
        *[column(c) for c in loads.columns if c != "created_at"], *created
    )
    return merge_always(control, updates, "name")


def mark_optimised(control: DataFrame, runs: DataFrame) -> DataFrame:
    """Control rows after maintenance: ``last_optimised`` and file metrics move on."""
    return merge_always(control, runs, "name")


def append_load(rows: DataFrame, log: str, load: str) -> None:
    """Append what a load sets in control rows to a log, under the load's own name.

    ``rows`` have ``name``, ``version`` and any other columns.  Loads of several tables may
    append at once; the same load again replaces what it had appended.
    """
    (
        rows.withColumn(LOAD, F.lit(load))
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD)
        .parquet(log)
    )


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """Control rows from a log: of each table the newest version, of each column the
    newest value that is set.  A load that sets a column to null leaves it as it was."""
    rows = spark.read.option("mergeSchema", "true").parquet(log)
    columns = [c for c in rows.columns if c not in ("name", LOAD)]
    newest = [
        F.max_by(column(c), F.when(column(c).isNotNull(), F.struct("version", LOAD))).alias(c) for c in columns
    ]
    return rows.groupBy("name").agg(*newest)


def latest_version(spark: SparkSession, log: str, name: str) -> int | None:
    """The newest version of a table, from its rows in the log alone; None before its first load."""
    return spark.read.parquet(log).where(F.col("name") == name).agg(F.max("version")).first()[0]
