"""ML helpers over whole tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from sluicework.operators import learn
from sluicework.registry.common import Query, table


def label_encode(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return learn.label_encoder(orders, "o_orderpriority")


LABEL_ENCODE = """
SELECT o_orderkey, o_orderpriority, label FROM orders JOIN (
  SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE) AS label
  FROM orders GROUP BY o_orderpriority) USING (o_orderpriority)
"""


def vectorize(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    vectors = learn.vectorize(part, ["p_size", "p_retailprice"])
    return vectors.select("p_partkey", F.to_json(vector_to_array("features")).alias("features"))


VECTORIZE = """
SELECT p_partkey, concat('[', CAST(CAST(p_size AS DOUBLE) AS VARCHAR), ',', CAST(p_retailprice AS VARCHAR), ']') AS features
FROM part
"""


def split_sizes(spark, sf_dir):
    """Sizes of both kinds of split, and how the two sides of each meet."""
    orders = table(spark, sf_dir, "orders")
    again = orders.repartition(5, "o_custkey")
    sides = {
        "key": learn.train_test_split(orders, 0.3, 7, key="o_orderkey"),
        "random": learn.train_test_split(orders, 0.3, 7),
    }
    other = {"key": learn.train_test_split(again, 0.3, 7, key="o_orderkey")[1], "random": sides["random"][1]}

    def marked(df, kind, train, test, test_again):
        return df.select(
            F.lit(kind).alias("kind"), "o_orderkey", F.lit(train).alias("train"), F.lit(test).alias("test"), F.lit(test_again).alias("again")
        )

    rows = None
    for kind, (train, test) in sides.items():
        for part in (marked(train, kind, 1, 0, 0), marked(test, kind, 0, 1, 0), marked(other[kind], kind, 0, 0, 1)):
            rows = part if rows is None else rows.unionAll(part)
    by_order = rows.groupBy("kind", "o_orderkey").agg(*(F.sum(c).alias(c) for c in ("train", "test", "again")))
    share = F.avg(F.col("test").cast("double"))
    return by_order.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("train") + F.col("test") != 1).cast("int")).alias("twice_or_never"),
        F.sum((F.col("test") != F.col("again")).cast("int")).alias("moved"),
        # Six standard deviations of a share of 0.3.
        (F.abs(share - 0.3) <= 6 * F.sqrt(F.lit(0.21) / F.count(F.lit(1)))).alias("share_fits"),
    )


SPLIT_SIZES = """
SELECT kind, count(*) AS n, 0::BIGINT AS twice_or_never, 0::BIGINT AS moved, true AS share_fits
FROM orders CROSS JOIN (VALUES ('key'), ('random')) AS kinds(kind) GROUP BY kind
"""


def _labelled(spark, sf_dir):
    """Whole embeddings as features of a two-class problem."""
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        (F.col("label") > 4).cast("double").alias("label"),
        array_to_vector("embedding").alias("vector"),
    )
    return learn.vectorize(vectors, ["vector"]).select("vec_id", "label", "features")


def _separable(spark, sf_dir):
    """Whole order lines with a label that a line through the features tells, with room."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_quantity") > 25).cast("double").alias("label"),
        ((F.col("l_quantity") - 25.5) / 25).alias("quantity"),
        F.col("l_discount").alias("discount"),
    )
    return learn.vectorize(lines, ["quantity", "discount"])


def _by_label(scored):
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count("prediction").alias("predicted"), (right >= 0.95).alias("learned")
    )


def train_lr(spark, sf_dir):
    data = _separable(spark, sf_dir)
    return _by_label(learn.logistic_regression(data, maxIter=50).transform(data))


def train_mlp(spark, sf_dir):
    data = _separable(spark, sf_dir)
    return _by_label(learn.nn(data, [2, 4, 2], random_state=1, maxIter=60).transform(data))


TRAINED = """
SELECT CAST(l_quantity > 25 AS DOUBLE) AS label, count(*) AS n, count(*) AS predicted, true AS learned
FROM lineitem GROUP BY 1
"""


def train_vectors(spark, sf_dir):
    """A classifier of whole embeddings: every row is scored by one of the two classes."""
    data = _labelled(spark, sf_dir)
    scored = learn.logistic_regression(data, maxIter=20).transform(data)
    known = F.col("prediction").isin(0.0, 1.0)
    return scored.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(known, 1)).alias("scored"))


TRAIN_VECTORS = """
SELECT CAST(label > 4 AS DOUBLE) AS label, count(*) AS n, count(*) AS scored FROM embeddings GROUP BY 1
"""


def evaluate_metrics(spark, sf_dir):
    flags = table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        (F.col("l_quantity") > 30).cast("double").alias("prediction"),
    )
    found = [
        ("binary", learn.evaluate(flags)),
        ("multiclass", learn.evaluate(flags, "multiclass")),
        ("area", learn.evaluate(flags, "binary", "areaUnderROC")),
    ]
    return spark.createDataFrame([(k, round(v, 9)) for k, v in found], "kind STRING, score DOUBLE")


EVALUATE_METRICS = """
WITH flags AS (SELECT l_returnflag = 'R' AS label, l_quantity > 30 AS guess FROM lineitem),
accuracy AS (SELECT round(avg(CASE WHEN label = guess THEN 1.0 ELSE 0.0 END), 9) AS score FROM flags)
SELECT 'binary' AS kind, score FROM accuracy
UNION ALL SELECT 'multiclass', score FROM accuracy
UNION ALL SELECT 'area', round((avg(CASE WHEN guess THEN 1.0 ELSE 0.0 END) FILTER (WHERE label)
  + 1 - avg(CASE WHEN guess THEN 1.0 ELSE 0.0 END) FILTER (WHERE NOT label)) / 2, 9) FROM flags
"""

QUERIES = {
    "label_encode": Query(label_encode, LABEL_ENCODE),
    "vectorize": Query(vectorize, VECTORIZE),
    "split_sizes": Query(split_sizes, SPLIT_SIZES),
    "train_lr": Query(train_lr, TRAINED),
    "train_mlp": Query(train_mlp, TRAINED),
    "train_vectors": Query(train_vectors, TRAIN_VECTORS),
    "evaluate_metrics": Query(evaluate_metrics, EVALUATE_METRICS),
}
