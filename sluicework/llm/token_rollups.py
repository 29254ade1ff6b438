"""Token totals by source, language and tokenizer version, kept up by signed changes.

A change is a count with a sign: an insert adds, a delete subtracts what was added, a
revised count does both. Each batch of changes is summed by group and written under
its name, in one commit; a batch that is there already is not written again. Totals
are the sums over all batches, in whatever order they came.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm.tasks import map_arrow
from sluicework.llm.tokens import ID_BYTES, word_tokenizer

GROUP = ("source", "lang", "version")
SUMS = ("documents", "tokens", "chars")
SCHEMA = "source string, lang string, version string, documents long, tokens long, chars long, batch string"

#: Texts counted at a time.
CHUNK = 512


@functools.lru_cache(maxsize=2)
def _byte_encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _lengths(path: str, texts: list[str | None]) -> list[int]:
    if path.endswith(".tiktoken"):
        encoding = _byte_encoding(path)
        return [len(encoding.encode_ordinary(text)) if text else 0 for text in texts]
    return [len(ids) // ID_BYTES for ids in word_tokenizer(path).encode(texts)]


def count_tokens(documents: DataFrame, tokenizer_path: str, version: str) -> DataFrame:
    """``doc_id``, the group, ``tokens`` and ``chars`` of every document. The tokenizer is
    a byte-level ``.tiktoken`` file or a ``.json`` file that drops white space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                counts = pa.array(_lengths(tokenizer_path, batch.column("text").to_pylist()), pa.int64())
                columns = [batch.column(c) for c in ("doc_id", "source", "lang", "chars")]
                yield pa.RecordBatch.from_arrays([*columns, counts], ["doc_id", "source", "lang", "chars", "tokens"])

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"),
        F.col("text").cast("string").alias("text"),
    )
    counted = map_arrow(texts, run, "doc_id long, source string, lang string, chars long, tokens long")
    return counted.select("doc_id", "source", "lang", F.lit(version).alias("version"), "tokens", "chars")


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Counts as inserts (1) or deletes (-1)."""
    return counts.select("source", "lang", "version", "tokens", "chars", F.lit(sign).alias("sign"))


def create(spark: SparkSession, path: str) -> None:
    """An empty rollup; one that exists stays as it is."""
    spark.createDataFrame([], SCHEMA).write.mode("append").partitionBy("batch").parquet(path)


def _committed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def commit(path: str, batch: str, changes: DataFrame) -> bool:
    """Adds a batch of signed changes, once; False if the rollup has it.

    Needs the group, ``tokens``, ``chars`` and ``sign``; other columns are ignored. Null
    group values are values; null counts are 0, rows without a sign are no change.
    Groups of any size are summed before they are shuffled. An empty batch, or one of
    which nothing is left, adds nothing. A commit that is broken off leaves the rollup as
    it was and can be repeated; if two commit one batch, both write the same.
    """
    spark = changes.sparkSession
    if not _committed(spark, path).filter(F.col("batch") == batch).isEmpty():
        return False

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(F.col("sign") * F.coalesce(value, F.lit(0))), F.lit(0)).cast("long")

    sums = changes.filter("sign IS NOT NULL").groupBy(*GROUP).agg(
        total(F.lit(1)).alias("documents"), total(F.col("tokens")).alias("tokens"), total(F.col("chars")).alias("chars")
    )
    (
        sums.withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(path)
    )
    return True


def totals(spark: SparkSession, path: str) -> DataFrame:
    """The sums of each group over all batches; groups that came to nothing are left out."""
    sums = _committed(spark, path).groupBy(*GROUP).agg(*(F.sum(c).alias(c) for c in SUMS))
    return sums.filter(" OR ".join(f"{c} <> 0" for c in SUMS))
