import hashlib
import math

from pyspark.sql import functions as F

from sluicework.llm import poisson_mix as module
from sluicework.llm.poisson_mix import poisson_mix
from tests.llm.helpers import DOCUMENT, documents


def drawn(name, rate, seed=0):
    """The inverse of the distribution at the hashes, by plain loops."""
    parts = max(1, math.ceil(rate / 16))
    count = 0
    for part in range(1, parts + 1):
        u = int(hashlib.md5(f"{seed}:{name}:{part}".encode()).hexdigest()[:13], 16) / 2**52
        p = below = math.exp(-rate / parts)
        k = 0
        while below <= u:
            k += 1
            p *= rate / parts / k
            below += p
        count += k
    return count


def _corpus(spark, n=400):
    return documents(spark, [(i, f"t{i}") for i in range(n)], {i: "hot" if i % 3 == 0 else f"s{i % 7}" for i in range(n)})


def _counts(df):
    return {r.doc_id: r["count"] for r in df.groupBy("doc_id").count().collect()}


def test_counts_are_the_inverse(spark):
    df = _corpus(spark)
    sizes = {r.source: r["count"] for r in df.groupBy("source").count().collect()}
    found = _counts(poisson_mix(df))
    for row in df.collect():
        assert found.get(row.doc_id, 0) == drawn(row.doc_id, 400 / len(sizes) / sizes[row.source])


def test_weights_and_high_rates(spark):
    df = _corpus(spark, 60)
    weights = spark.createDataFrame([("hot", 2.0), ("hot", 1.0), ("s1", 1.0), ("gone", 4.0), ("s2", None), ("s4", 0.0)], "source string, weight double")
    found = poisson_mix(df, weights, target_rows=8000)
    by_source = {r.source: r["count"] for r in found.groupBy("source").count().collect()}
    assert set(by_source) == {"hot", "s1"}
    assert abs(by_source["hot"] - 6000) < 400 and abs(by_source["s1"] - 2000) < 250
    counts = _counts(found)
    assert all(counts[i] == drawn(i, 6000 / 20) for i in range(0, 60, 3))


def test_joined_by_salt(spark, monkeypatch):
    plain = _counts(poisson_mix(_corpus(spark)))
    monkeypatch.setattr(module, "BROADCAST_SOURCES", 0)
    assert _counts(poisson_mix(_corpus(spark))) == plain


def test_copies_are_numbered_and_in_random_order(spark):
    rows = poisson_mix(_corpus(spark), target_rows=4000).collect()
    by_document = {}
    for r in rows:
        by_document.setdefault(r.doc_id, []).append(r)
    for own in by_document.values():
        assert sorted(r.copy for r in own) == list(range(1, own[0].n_copies + 1))
    ids = [r.doc_id for r in rows]
    assert sum(abs(a - b) for a, b in zip(ids, ids[1:])) / len(ids) > 60


def test_nulls_repeated_rows_other_columns_and_empty(spark):
    df = documents(spark, [(None, "a"), (None, None), (3, ""), (3, ""), (4, "x" * 10**6)], {None: None})
    df = df.withColumn("rate", F.lit(1)).withColumn("copy", F.lit("y")).withColumn("name", F.lit(2)).withColumn("row", F.lit(3))
    found = poisson_mix(df, target_rows=200)
    assert found.columns == [*DOCUMENT.replace(",", "").split()[::2], "rate", "name", "row", "copy", "n_copies", "order_key"]
    rows = found.collect()
    assert {r.text for r in rows} == {"a", None, "", "x" * 10**6}
    assert sum(r.doc_id == 3 for r in rows) == 2 * max(r.n_copies for r in rows if r.doc_id == 3)
    assert poisson_mix(spark.createDataFrame([], DOCUMENT)).collect() == []
