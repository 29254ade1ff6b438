"""Packs documents into sequences along a space-filling curve.

A document's tokens are hashed into a vector, the vector is projected to four
dimensions, each is cut at its quantiles over all documents, and the cells are put in
the order of a Hilbert curve. Ranges of the curve are sorted apart; with the tokens
that come before each range, every document knows its place in one long row of
tokens, which is cut into sequences.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.tasks import map_arrow
from sluicework.llm.tokens import ID_BYTES, word_tokenizer
from sluicework.sources.scratch import scratch_dir

DIMENSIONS = 4
BITS = 8
HASHED = 256
SEED = 7

#: Bits below the curve's that spread documents of one cell.
TIE_BITS = 20

#: Tokens in a range of the curve. The number of ranges is bounded, as their bounds and
#: totals pass through the driver; beyond that ranges grow, and are sorted on disk.
RANGE_TOKENS = 4_000_000
MAX_RANGES = 50_000

#: Documents tokenized at a time.
CHUNK = 512


@functools.lru_cache(maxsize=2)
def _projection(ids: int) -> np.ndarray:
    """What one token of each id adds to a document's place: its signed bucket, projected."""
    rng = np.random.default_rng(SEED)
    axes = rng.standard_normal((HASHED, DIMENSIONS))
    return (axes[rng.integers(0, HASHED, ids)] * rng.choice([-1.0, 1.0], (ids, 1))).astype(np.float32)


def _tokenize(path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                encoded = [ids + end for ids in tokenizer.encode(batch.column("text").to_pylist())]
                counts = np.array([len(ids) // ID_BYTES for ids in encoded])
                flat = np.frombuffer(b"".join(encoded), "<u4")
                added = _projection(max(tokenizer.size, end_id + 1))[flat]
                place = np.add.reduceat(added, np.cumsum(counts) - counts, axis=0) / counts[:, None]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("tie"), pa.array(counts), pa.array(encoded, pa.binary())]
                    + [pa.array(place[:, i].astype(np.float64)) for i in range(DIMENSIONS)],
                    ["doc_id", "tie", "doc_tokens", "ids", *(f"x{i}" for i in range(DIMENSIONS))],
                )

    return run


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with ``bits`` bits in each column.

    Undoes, bit by bit from the top, the exchanges and inversions by which the curve
    turns into its sub-cubes, then reads the Gray code across the columns.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for i in range(n):
            is_set = (x[i] & level) != 0
            swapped = np.where(is_set, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(is_set, below, swapped)
            x[i] ^= swapped
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn ^= np.where((x[n - 1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= turn
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> bit) & 1)
    return index


def _curve_rank(bounds: list[np.ndarray]):
    @F.pandas_udf("long")
    def rank(tie: pd.Series, x0: pd.Series, x1: pd.Series, x2: pd.Series, x3: pd.Series) -> pd.Series:
        cells = [np.searchsorted(b, x.to_numpy(), "right") for b, x in zip(bounds, (x0, x1, x2, x3), strict=True)]
        return pd.Series((hilbert_index(np.stack(cells, 1), BITS) << TIE_BITS) | tie.to_numpy())

    return rank


def _range_of(bounds: np.ndarray):
    @F.pandas_udf("long")
    def place(rank: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, rank.to_numpy(), "right"))

    return place


def _quantiles(count: int) -> list[float]:
    return [i / count for i in range(1, count)]


def pack_along_curve(documents: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces of documents in sequences of ``capacity`` tokens, similar documents together.

    Takes ``doc_id`` and ``text``; other columns are ignored. Every document is its
    tokens and ``end_id``; it is cut wherever a sequence ends, so only the last sequence
    is not full. Returns per piece ``doc_id``, ``start`` (the document's tokens before
    it), ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id``, ``offset`` (its place in the sequence).

    Null and empty texts are the ``end_id`` alone. Long texts fill as many sequences as
    they need. Equal documents are neighbours in an order given by doc_id, repeated rows
    are packed once each, and a null doc_id is kept. An empty table gives no rows.
    """
    spark = documents.sparkSession
    tie = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << TIE_BITS) - 1))
    path = scratch_dir(spark)
    map_arrow(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), tie.alias("tie"), F.col("text").cast("string").alias("text")),
        _tokenize(tokenizer_path, end_id),
        "doc_id long, tie long, doc_tokens long, ids binary, " + ", ".join(f"x{i} double" for i in range(DIMENSIONS)),
    ).write.option("compression", "zstd").parquet(path)
    tokenized = spark.read.parquet(path)

    axes = [f"x{i}" for i in range(DIMENSIONS)]
    known = tokenized.agg(
        F.coalesce(F.sum("doc_tokens"), F.lit(0)).alias("total"),
        *(F.percentile_approx(x, _quantiles(1 << BITS), 10_000).alias(x) for x in axes),
    ).first()
    ranges = min(MAX_RANGES, max(1, math.ceil(known["total"] / RANGE_TOKENS)))
    ranked = tokenized.withColumn("rank", _curve_rank([np.array(known[x] or []) for x in axes])("tie", *axes)).drop("tie", *axes)
    bounds = np.array([], np.int64)
    if ranges > 1:
        bounds = np.array(
            ranked.agg(F.percentile_approx("rank", _quantiles(ranges), max(10_000, 20 * ranges))).first()[0], np.int64
        )
    placed = ranked.withColumn("range", _range_of(bounds)("rank"))
    totals = {row["range"]: row["tokens"] for row in placed.groupBy("range").agg(F.sum("doc_tokens").alias("tokens")).collect()}
    before, starts = 0, []
    for part in sorted(totals):
        starts.append((part, before))
        before += totals[part]

    along = Window.partitionBy("range").orderBy("rank", "doc_id", "doc_tokens", F.crc32("ids"))
    earlier = F.coalesce(F.sum("doc_tokens").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = F.col("first_token") + F.col("start")
    return (
        placed.join(F.broadcast(spark.createDataFrame(starts, "range long, range_start long")), "range")
        .withColumn("first_token", F.col("range_start") + earlier)
        .withColumn("last_token", F.col("first_token") + F.col("doc_tokens") - 1)
        .withColumn(
            "sequence_id",
            F.explode(F.sequence(F.floor(F.col("first_token") / capacity), F.floor(F.col("last_token") / capacity))),
        )
        .withColumn("start", F.greatest(F.lit(0), F.col("sequence_id") * capacity - F.col("first_token")))
        .withColumn(
            "length",
            F.least("doc_tokens", (F.col("sequence_id") + 1) * capacity - F.col("first_token")) - F.col("start"),
        )
        .select(
            "doc_id",
            "start",
            "length",
            F.substring("ids", (F.col("start") * ID_BYTES + 1).cast("int"), (F.col("length") * ID_BYTES).cast("int")).alias("ids"),
            "doc_tokens",
            "sequence_id",
            (at - F.col("sequence_id") * capacity).alias("offset"),
        )
    )
