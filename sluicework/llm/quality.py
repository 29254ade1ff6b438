"""Ordinal quality classifier: cumulative-link regression on hashed text.

A document has one score, the sum of the weights of its features; thresholds in
ascending order cut the score into grades: P(grade <= k) = logistic(threshold_k - score).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.tasks import map_arrow, release_memory
from sluicework.llm.words import hash_words, words_of
from sluicework.sources.scratch import written_out

#: Rated documents that a fit takes: rare grades whole, as many of the others as are left,
#: chosen by a hash of doc_id and weighted by the share of their grade. They and
#: their features pass through the driver; everything else covers all documents.
MAX_RATED = 12_000

FEATURE_BITS = 18

#: Longer words count by their start as well.
STEM_BYTES = 5

#: Rated documents that must have a feature for it to get a weight.
LEAST_RATED = 2

STEPS = 150
RATE = 0.2
RIDGE = 5e-5

#: Marks that are no part of the word they stand at.
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())

_WIDTH = 1 << FEATURE_BITS
_MASK = np.uint64(_WIDTH - 1)

#: Weight of a word's presence against a share of the text.
_WORD_VALUE = 0.25


def _named(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name.encode()) & (_WIDTH - 1)


_BYTE_SHARE = np.array([_named(f"byte {b}") for b in range(256)])
_DISTINCT = np.array([_named(f"distinct {i}") for i in range(11)])
_AGAIN = np.array([_named(f"again {i}") for i in range(11)])
_LENGTH = np.array([_named(f"length {i}") for i in range(65)])
_MEAN = np.array([_named(f"word length {i}") for i in range(33)])


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and values: words and word starts present, shares of bytes that are no letter or
    are upper case, and how long, varied and repetitive the words are."""
    words = words_of(text)
    if not words:
        return _LENGTH[:1], np.ones(1)
    hashes = hash_words([word.strip(_MARKS) or word for word in words])
    distinct = np.unique(hashes)
    stems = hash_words(list({b"-" + word[:STEM_BYTES] for word in (word.strip(_MARKS) for word in words) if len(word) > STEM_BYTES}))
    present = np.unique((np.concatenate([distinct, stems]) & _MASK).astype(np.int64))
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    counts[ord("a") : ord("z") + 1] = 0
    counts[128:] = 0
    used = np.flatnonzero(counts)
    again = np.count_nonzero(hashes[1:] == hashes[:-1]) / len(words)
    places = (
        _DISTINCT[int(10 * len(distinct) / len(words))],
        _AGAIN[int(10 * again)],
        _LENGTH[len(words).bit_length()],
        _MEAN[min(32, sum(map(len, words)) // len(words))],
    )
    index = np.concatenate([present, _BYTE_SHARE[used], places])
    value = np.concatenate([np.full(len(present), _WORD_VALUE), np.sqrt(counts[used] / len(text)), np.ones(len(places))])
    return index, value


@dataclass(frozen=True)
class OrdinalModel:
    """Weights shared by all grades, and the thresholds between them in ascending order."""

    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, text: str | None) -> float:
        index, value = features(text)
        return float(self.weights[index] @ value)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k, by column."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _features_of(batches):
    import pyarrow as pa

    for batch in batches:
        found = [features(text) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("grade"),
                pa.array([i.astype("<i4").tobytes() for i, _ in found], pa.binary()),
                pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary()),
            ],
            ["grade", "places", "parts"],
        )


def _chosen(ratings: DataFrame, most: int) -> tuple[DataFrame, dict[int, float]]:
    """At most so many rated ids with their grades, and for each grade how many ratings one stands for.

    The rarest grade gets an equal part of the places, or as many as it fills; the next one an equal part of
    what is left.
    """
    rated = written_out(
        ratings.filter("doc_id IS NOT NULL AND grade IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("rated_id"))
        .agg(F.min("grade").cast("int").alias("grade"))
    )
    counts = sorted((r["count"], r["grade"]) for r in rated.groupBy("grade").count().collect())
    chosen, shares = rated.limit(0), {}
    for k, (count, grade) in enumerate(counts):
        taken = min(count, most // (len(counts) - k))
        most -= taken
        if taken:
            own = rated.filter(F.col("grade") == grade)
            chosen = chosen.unionAll(own if taken == count else own.orderBy(F.xxhash64("rated_id"), "rated_id").limit(taken))
            shares[grade] = count / taken
    return chosen, shares


def fit(documents: DataFrame, ratings: DataFrame, max_rated: int = MAX_RATED) -> OrdinalModel:
    """A model of ``ratings`` (``doc_id``, ``grade`` from 0 up) of the documents.

    Null grades and doc_ids are left out; of several ratings of a document the lowest
    counts. With fewer than two grades the model knows nothing: weights are 0, the
    thresholds let every document pass.
    """
    rated, shares = _chosen(ratings, max_rated)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most max_rated rows of two numbers.
    sample = texts.join(F.broadcast(rated), F.col("doc_id") == F.col("rated_id")).select("grade", "text")
    rows = map_arrow(sample, _features_of, "grade int, places binary, parts binary").toArrow()
    grades = np.array(rows.column("grade").to_pylist(), np.int64)
    if len(np.unique(grades)) < 2:
        return OrdinalModel(np.zeros(_WIDTH, np.float32), np.array([-50.0]))
    places, parts = (b"".join(rows.column(c).to_pylist()) for c in ("places", "parts"))
    sizes = np.array([len(b) // 4 for b in rows.column("places").to_pylist()])
    del rows
    weight = np.array([shares[g] for g in grades.tolist()])
    return _fitted(grades, weight / weight.mean(), np.repeat(np.arange(len(grades), dtype=np.int32), sizes), np.frombuffer(places, "<i4"), np.frombuffer(parts, "<f4"))


def _certain(grades: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """How far each feature surely tells grades apart: the logarithm of the ratio of its shares on the two
    sides of a threshold, less one standard error, at the threshold where it is largest."""
    found = np.zeros(_WIDTH)
    for cut in range(int(grades.max())):
        low = grades <= cut
        below, above = (np.bincount(column[side[row]], minlength=_WIDTH) + 0.5 for side in (low, ~low))
        ratio = np.log(below / (low.sum() + 1)) - np.log(above / ((~low).sum() + 1))
        np.maximum(found, np.abs(ratio) - np.sqrt(1 / below + 1 / above), out=found)
    return found


def _fitted(grades: np.ndarray, weight: np.ndarray, row: np.ndarray, column: np.ndarray, value: np.ndarray) -> OrdinalModel:
    """Maximum likelihood with a ridge, by Adam on all rows; each counts by its weight.

    Values are scaled by what their feature surely tells. Else the many words that happen to be in one
    document only fit its grade in place of the few that make it.
    """
    rows = np.arange(len(grades))
    scale = np.where(np.bincount(column, minlength=_WIDTH) >= LEAST_RATED, _certain(grades, row, column), 0)
    used = scale[column] > 0
    row, column, value = row[used], column[used], value[used]
    value = value * scale[column]
    cuts = int(grades.max())
    # The first threshold, and the logarithms of the gaps to the next ones.
    shape = np.concatenate([[-2.0], np.zeros(cuts - 1)])
    weights = np.zeros(_WIDTH)
    state = [np.zeros(_WIDTH + cuts), np.zeros(_WIDTH + cuts)]
    for step in range(1, STEPS + 1):
        score = np.bincount(row, weights[column] * value, len(rows))
        thresholds = shape[0] + np.concatenate([[0.0], np.cumsum(np.exp(shape[1:]))])
        below = np.column_stack([np.zeros(len(rows)), _logistic(thresholds[None, :] - score[:, None]), np.ones(len(rows))])
        high, low = below[rows, grades + 1], below[rows, grades]
        mass = np.maximum(high - low, 1e-12)
        by_score = weight * (1 - high - low) / len(rows)
        by_threshold = np.zeros(cuts + 2)
        np.add.at(by_threshold, grades + 1, -weight * high * (1 - high) / mass / len(rows))
        np.add.at(by_threshold, grades, weight * low * (1 - low) / mass / len(rows))
        by_threshold = by_threshold[1:-1]
        later = np.cumsum(by_threshold[::-1])[::-1]
        by_shape = np.concatenate([later[:1], later[1:] * np.exp(shape[1:])])
        by_weight = np.bincount(column, by_score[row] * value, _WIDTH) + RIDGE * weights
        slope = np.concatenate([by_weight, by_shape])
        state[0] = 0.9 * state[0] + 0.1 * slope
        state[1] = 0.99 * state[1] + 0.01 * slope * slope
        move = RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-7)
        weights -= move[:_WIDTH]
        shape -= move[_WIDTH:]
    thresholds = shape[0] + np.concatenate([[0.0], np.cumsum(np.exp(shape[1:]))])
    return OrdinalModel((weights * scale).astype(np.float32), thresholds)


def graded(model: OrdinalModel, text: Column | str) -> Column:
    """A struct of ``expected_grade`` and ``tail``: the probability of the highest grade."""

    @F.pandas_udf("expected_grade double, tail double")
    def run(texts: pd.Series) -> pd.DataFrame:
        tails = model.tails(np.array([model.score(text) for text in texts]))
        release_memory()
        return pd.DataFrame({"expected_grade": tails.sum(1), "tail": tails[:, -1]})

    return run(text)


def grades_of(labels: DataFrame) -> DataFrame:
    """Grades 0 to 2 from ``labels``: low quality, good but toxic, good and clean."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def classify(documents: DataFrame, ratings: DataFrame, least_tail: float = 0.5, max_rated: int = MAX_RATED) -> DataFrame:
    """The documents with ``expected_grade``, ``tail`` (probability of the highest
    grade) and ``keep`` (``tail`` is at least ``least_tail``).

    Needs ``doc_id`` and ``text``; all columns are returned, of those three names
    replaced. Null and empty texts are graded by their length alone; long texts are
    read whole. Equal texts get equal grades, repeated rows stay. Without ratings of two
    grades every document is kept. An empty table gives no rows.
    """
    model = fit(documents, ratings, max_rated)
    own = {"expected_grade", "tail", "keep"}
    columns = [c for c in documents.columns if c.lower() not in own]
    return (
        documents.select(F.struct(*columns).alias("row"), graded(model, F.col("text").cast("string")).alias("grade"))
        .select(
            *(F.col("row")[c].alias(c) for c in columns),
            F.col("grade.expected_grade").alias("expected_grade"),
            F.col("grade.tail").alias("tail"),
            (F.col("grade.tail") >= least_tail).alias("keep"),
        )
    )
