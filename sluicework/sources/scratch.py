"""Where intermediate tables go."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new path in the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local master may do without the setting; it gets a temporary folder
    that goes with the process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/sluicework-{uuid.uuid4().hex}"
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="sluicework-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Within it, the session has another setting."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_freed(spark: SparkSession):
    """Within it, what a write has shuffled leaves the disk as soon as it has ended, not when the driver collects its garbage."""
    return session_conf(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def written_out(df: DataFrame) -> DataFrame:
    """The same rows as a table in the scratch folder, computed once."""
    path = scratch_dir(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_apart(df: DataFrame) -> DataFrame:
    """The same rows as a table in the scratch folder, each in a row group of its own: of rows of many megabytes, those who write or read them hold one at a time."""
    path = scratch_dir(df.sparkSession)
    df.write.mode("overwrite").option("parquet.block.row.count.limit", 1).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
