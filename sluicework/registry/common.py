"""What query modules share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    """A Spark query over the test tables and, where SQL can say it, the same in SQL."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
