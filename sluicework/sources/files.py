"""File scans."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluicework.operators.schema import quoted

# Source kinds whose files wrap the row in an envelope struct.
ENVELOPED_SOURCES = ("mongo", "postgress")
ENVELOPE = "_airbyte_data"

EXCEL_FORMAT = "com.crealytics.spark.excel"


def read_files(
    spark: SparkSession,
    path: str | list[str],
    modified_after: str | datetime | None,
    file_format: str,
    source: str = "mongo",
    schema: StructType | str | None = None,
    envelope: str = ENVELOPE,
    **options: str,
) -> DataFrame:
    """Rows of all files under ``path`` changed after a watermark.

    Files are pruned by modification time when they are listed; the watermark is
    read in UTC whatever the session's zone.  Enveloped sources are unwrapped.  With
    a schema no file is opened to infer one.  No matching file means no rows: with a
    schema those of the schema, without one those of a single file, the newest.
    """
    reader = spark.read.format(file_format).options(recursiveFileLookup="true", **options)
    if "timeZone" not in options:
        reader = reader.option("timeZone", "UTC")
    if modified_after is not None:
        after = modified_after
        if isinstance(after, datetime):
            after = after.strftime("%Y-%m-%dT%H:%M:%S")
        reader = reader.option("modifiedAfter", after)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.load(path)
    except AnalysisException as error:
        if modified_after is None or error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        newest = listed_files(spark, path).orderBy(F.desc("modified"), "path").first()
        if newest is None:
            raise
        df = spark.read.format(file_format).options(**options).load(newest["path"]).where("false")
    return unwrap_envelope(df, envelope) if source in ENVELOPED_SOURCES else df


def listed_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``path``, ``modified`` and ``size`` of all files below; none is opened."""
    paths = [path] if isinstance(path, str) else list(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def unwrap_envelope(df: DataFrame, envelope: str = ENVELOPE) -> DataFrame:
    return df.select(f"{quoted(envelope)}.*")


def read_snapshot(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Current state of a target table."""
    return spark.read.format(file_format).load(path)


def read_sheet(
    spark: SparkSession, path: str, sheet_name: str | None = None, infer_types: bool = False
) -> DataFrame:
    """A table with a header row: a CSV file, or a sheet where the Excel source is installed.

    Cells are strings, or typed by inference with empty cells as null.
    """
    options = {"header": "true", "inferSchema": str(infer_types).lower()}
    if sheet_name is None:
        if infer_types:
            options["nullValue"] = ""
        return spark.read.format("csv").options(**options).load(path)
    options["dataAddress"] = f"'{sheet_name}'!A1"
    if infer_types:
        options["treatEmptyValuesAsNulls"] = "true"
    return spark.read.format(EXCEL_FORMAT).options(**options).load(path)
