"""Files that loads have consumed, by path and modification time.

A watermark of file times loses files that arrive late with an old time, or at the very
time of the last one seen. A ledger knows each file: what is listed and not in it is new,
whatever its time. Each load keeps its files under its own name, so a load that is
repeated reads and records the same files again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluicework.sources.files import ENVELOPED_SOURCES, listed_files, unwrap_envelope

LOAD = "load"
_LEDGER = f"path STRING, modified TIMESTAMP, {LOAD} STRING"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """``path``, ``modified`` and ``load`` of every consumed file; empty before the first load."""
    try:
        return spark.read.schema(_LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LEDGER)


def unseen_files(spark: SparkSession, path: str | Sequence[str], ledger: str, load: str) -> DataFrame:
    """Listed files that no other load than ``load`` has consumed as they are now."""
    seen = read_ledger(spark, ledger).where(F.col(LOAD) != load)
    return listed_files(spark, path).join(seen, ["path", "modified"], "left_anti")


def consume(files: DataFrame, ledger: str, load: str) -> None:
    """Record the files of a load; recording the same load again replaces what it had."""
    (
        files.select("path", "modified", F.lit(load).alias(LOAD))
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD)
        .parquet(ledger)
    )


def next_watermark(files: DataFrame) -> str | None:
    """The latest time of the files themselves, in UTC; None without files."""
    return files.agg(F.date_format(F.to_utc_timestamp(F.max("modified"), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]


def read_unseen(
    spark: SparkSession,
    files: DataFrame,
    file_format: str,
    schema: StructType | str,
    source: str = "mongo",
    **options: str,
) -> DataFrame:
    """Rows of the given files.  Their paths pass through the driver, as any listing does."""
    paths = [r["path"] for r in files.select("path").collect()]
    reader = spark.read.format(file_format).options(**options).schema(schema)
    rows = reader.load(paths) if paths else spark.createDataFrame([], schema)
    return unwrap_envelope(rows) if source in ENVELOPED_SOURCES else rows

