"""Thin helpers around Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.operators.schema import column

# Metrics of scores rather than of predicted classes.
SCORE_METRICS = ("areaUnderROC", "areaUnderPR")
_HASH_STEPS = 1_000_000


def vectorize(data: DataFrame, features: Sequence[str]) -> DataFrame:
    """Assemble columns to a vector called ``features``."""
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(data)


def label_encoder(data: DataFrame, feature: str) -> DataFrame:
    """Index a column to ``label``, the most frequent value first."""
    return StringIndexer(inputCol=feature, outputCol="label").fit(data).transform(data)


def train_test_split(
    data: DataFrame, test_size: float = 0.3, random_state: int = 0, key: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Random train and test rows.

    With ``key`` a row falls to one side by the hash of its key, whatever the
    partitioning, and both sides are plain filters. Without, a row's side depends on
    its place in a partition, which a task that runs again may change.
    """
    if key is None:
        train, test = data.randomSplit([1 - test_size, test_size], random_state)
        return train, test
    step = F.pmod(F.xxhash64(column(key), F.lit(random_state)), F.lit(_HASH_STEPS))
    in_test = step < int(round(test_size * _HASH_STEPS))
    return data.where(~in_test), data.where(in_test)


def nn(
    data: DataFrame, layers: Sequence[int], random_state: int = 0, **params
) -> MultilayerPerceptronClassificationModel:
    """Fit a multilayer perceptron."""
    return MultilayerPerceptronClassifier(layers=list(layers), seed=random_state, **params).fit(data)


def logistic_regression(data: DataFrame, **params) -> LogisticRegressionModel:
    """Fit a logistic regression; the model comes without its training summary.

    The summary holds the session, and with it what cannot be sent to a task that
    scores, such as the observations of earlier writes.
    """
    model = LogisticRegression(**params).fit(data)
    model._java_obj.setSummary(data.sparkSession._jvm.scala.Option.empty())
    return model


def evaluate(data: DataFrame, type: str = "binary", metric: str = "accuracy") -> float:
    """Metric of predictions: areas from scores if present, others from classes."""
    if type not in ("binary", "multiclass"):
        raise ValueError(f"type must be 'binary' or 'multiclass', not {type!r}")
    if type == "binary" and metric in SCORE_METRICS:
        score = "rawPrediction" if "rawPrediction" in data.columns else "prediction"
        return BinaryClassificationEvaluator(
            labelCol="label", rawPredictionCol=score, metricName=metric
        ).evaluate(data)
    return MulticlassClassificationEvaluator(
        labelCol="label", predictionCol="prediction", metricName=metric
    ).evaluate(data)
