"""Hot keys, null keys and groups of copies: same rows, no task with the lot."""

import pytest
from pyspark.sql import functions as F

from sluicework.operators import skew
from sluicework.operators.dedup import latest_per_key
from sluicework.operators.merge import change_feed, merge_always, merge_insert, merge_newer


@pytest.fixture
def hot(spark):
    """A third of the rows on one key, a third without key, the rest spread; all tie."""
    return spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id")).alias("key"),
        F.lit(5).alias("inc"),
        (F.col("id") % 100).alias("payload"),
    )


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def largest_share(df):
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def test_sketch_finds_the_hot_keys(hot):
    digest = skew.key_hash(["key"], [hot.schema["key"].dataType])
    heavy = skew.heavy_hashes(hot, digest).collect()
    found = {r[skew.HASH] for r in heavy}
    assert all(5 <= r[skew.SALTS] <= 20 for r in heavy)
    expected = hot.where("key = 7 OR key IS NULL").select(digest).distinct().collect()
    assert found == {r[0] for r in expected}


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_lookup_join_gives_the_plain_join(shuffled, hot, how):
    right = shuffled.range(4000).select(F.col("id").cast("int").alias("key"), F.col("id").alias("found"))
    right = right.unionAll(shuffled.sql("SELECT CAST(NULL AS INT), -1L"))
    plain = hot.join(right, "key", how)
    salted = skew.lookup_join(hot, right, "key", how, split_above=0)
    assert "__salt" in salted._jdf.queryExecution().executedPlan().toString()
    assert same(plain.select(*salted.columns), salted)


def test_hot_and_null_keys_are_spread(shuffled, hot):
    shuffled.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        right = shuffled.range(4000).select(F.col("id").alias("key"), F.lit(1).alias("found"))
        assert largest_share(hot.join(right, "key", "left")) > 0.3
        assert largest_share(skew.lookup_join(hot, right, "key", "left", split_above=0)) < 0.25
        assert largest_share(latest_per_key(hot, "key", "inc")) > 0.3
        assert largest_share(latest_per_key(hot, "key", "inc", split_above=0)) < 0.25
    finally:
        shuffled.conf.set("spark.sql.adaptive.enabled", "true")


def test_copies_are_spread_by_map_task(shuffled):
    shuffled.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        copies = shuffled.range(0, 8000, 1, 64).select(F.lit(1).alias("key"), F.lit("x").alias("text"))
        right = shuffled.range(10).select(F.col("id").alias("key"), F.lit(1).alias("found"))
        assert largest_share(skew.lookup_join(copies, right, "key", "left", split_above=0)) < 0.4
    finally:
        shuffled.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("ties", ["all", "one"])
def test_latest_does_not_depend_on_the_split(hot, ties):
    rows = hot.withColumn("inc", F.col("payload") % 7)
    plain = latest_per_key(rows, "key", "inc", ties)
    assert same(plain, latest_per_key(rows, "key", "inc", ties, split_above=0).select(*plain.columns))


def test_merges_do_not_depend_on_the_split(shuffled, hot):
    batch = shuffled.range(3000).select(
        F.when(F.col("id") != 5, F.col("id")).alias("key"),
        (F.col("id") % 11).cast("int").alias("inc"),
        F.lit(-1).cast("bigint").alias("payload"),
    )
    for merge, extra in ((merge_newer, ["inc"]), (merge_always, []), (merge_insert, [])):
        plain = merge(hot, batch, "key", *extra)
        assert same(plain, merge(hot, batch, "key", *extra, split_above=0))


def test_change_feed_does_not_depend_on_the_split(shuffled, hot):
    after = hot.withColumn("payload", F.when(F.col("key") == 7, F.lit(-1)).otherwise(F.col("payload")))
    plain = change_feed(hot, after, "key")
    assert same(plain, change_feed(hot, after, "key", split_above=0))
    # 3000 copies of the hot key and the one row whose own id is 7.
    assert plain.where("_change_type = 'update_postimage'").count() == 3001
