import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sluicework.operators import learn


@pytest.fixture(scope="module")
def points(spark):
    rows = spark.range(400).select(
        "id", (F.col("id") % 20 - 10).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y")
    )
    return rows.withColumn("side", F.when(F.col("x") > 0, "right").otherwise("left"))


def test_encoder_orders_by_frequency(points):
    coded = learn.label_encoder(points, "side")
    found = {r["side"]: r["label"] for r in coded.select("side", "label").distinct().collect()}
    assert found == {"left": 0.0, "right": 1.0}


def test_models_learn_the_side(points):
    data = learn.label_encoder(learn.vectorize(points, ["x", "y"]), "side").cache()
    train, test = learn.train_test_split(data, 0.25, 3, key="id")
    assert train.count() + test.count() == 400 and 60 < test.count() < 140
    assert train.join(test, "id").isEmpty()
    for model in (learn.logistic_regression(train, maxIter=10), learn.nn(train, [2, 4, 2], 5, maxIter=60)):
        scored = model.transform(test)
        assert learn.evaluate(scored) > 0.9
        assert learn.evaluate(scored, "multiclass", "f1") > 0.9
        assert learn.evaluate(scored, "binary", "areaUnderROC") > 0.9


def test_split_by_key_ignores_partitioning(points):
    one = {r["id"] for r in learn.train_test_split(points, key="id")[1].collect()}
    two = {r["id"] for r in learn.train_test_split(points.repartition(7), key="id")[1].collect()}
    assert one == two
    parts = learn.train_test_split(points)
    assert sum(p.count() for p in parts) == 400


def test_area_without_scores_and_unknown_type(points):
    hard = points.select((F.col("x") > 0).cast("double").alias("label"), (F.col("x") > 5).cast("double").alias("prediction"))
    assert learn.evaluate(hard, "binary", "areaUnderROC") == pytest.approx((4 / 9 + 1) / 2)
    with pytest.raises(ValueError):
        learn.evaluate(hard, "ranking")


def test_scores_after_an_observed_write(spark, points, tmp_path):
    observed = Observation()
    points.observe(observed, F.count(F.lit(1)).alias("n")).write.parquet(str(tmp_path / "rows"))
    assert observed.get["n"] == 400
    data = learn.label_encoder(learn.vectorize(points, ["x", "y"]), "side")
    scored = learn.logistic_regression(data, maxIter=10).transform(data).collect()
    assert sum(r["prediction"] == r["label"] for r in scored) > 380
