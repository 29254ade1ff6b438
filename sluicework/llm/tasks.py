"""Arrow functions in tasks."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

import sluicework
from sluicework.sources.scratch import scratch_dir

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(sluicework.__file__)))


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose workers find this package where the driver has it."""
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return df.mapInArrow(_then_released(function), schema)


def _then_released(function):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        release_memory()

    return run


def release_memory() -> None:
    """Gives what a task has freed back to the system: workers are kept for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def packed_out(df: DataFrame) -> DataFrame:
    """The same rows as a table in the scratch folder, computed once and packed more closely: for many rows of numbers."""
    path = scratch_dir(df.sparkSession)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
