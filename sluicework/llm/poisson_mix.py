"""Mixes sources to target weights by Poisson replication.

Every document gets a number of copies from a Poisson distribution whose mean is the
repetition rate of its source: the source's share of the target over its rows. The
number is the inverse of the distribution at a hash of the document, so it is the
same in every run. Copies are put in an order given by another hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A rate above this is a sum of equal parts, each with a hash of its own; a sum of
#: Poisson numbers is one. At this rate the distribution ends within TERMS in doubles.
PART_RATE = 16.0
TERMS = 64

#: Sources whose rates are broadcast, as a table of that many rows is small. Beyond it,
#: rates are joined by source and one of so many salts.
BROADCAST_SOURCES = 10_000
SALTS = 32

_HEX_DIGITS = 13
_UNIT = float(1 << 4 * _HEX_DIGITS)


def _uniform(*parts: Column | str) -> Column:
    """A number from 0 to under 1 by the hash of the parts."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, _HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / _UNIT


def _distribution(rate: Column) -> Column:
    """P(X <= k) for each k below TERMS."""
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("sums"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS - 1)),
        start,
        lambda state, k: F.struct(
            (state["p"] * rate / k).alias("p"),
            F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + state["p"] * rate / k)).alias("sums"),
        ),
        lambda state: state["sums"],
    )


def poisson_mix(
    documents: DataFrame, weights: DataFrame | None = None, target_rows: int | None = None, seed: int = 0
) -> DataFrame:
    """Copies of the documents in random order, sources in the ratio of their weights.

    Needs ``doc_id``, ``text`` and ``source``; all columns are returned, and ``copy``
    (from 1), ``n_copies`` and ``order_key`` (columns of those names are replaced).
    ``weights`` has ``source`` and ``weight``, by default one for every source; a source
    that is not in it, or whose weight is null or not above 0, gets no copies, and
    repeated sources add up. ``target_rows`` is the expected size of the result, by
    default that of the input. Some documents get no copy: that is the distribution.

    A null source is a source. A null doc_id takes the hash of its text instead.
    Repeated rows get the same number of copies, each. Null, empty and long texts count
    as one document. An empty table gives no rows.
    """
    sizes = documents.groupBy(F.col("source").alias("of_source")).agg(F.count(F.lit(1)).alias("rows"))
    if weights is None:
        weighted = sizes.withColumn("weight", F.lit(1.0))
    else:
        given = weights.groupBy(F.col("source").alias("given_source")).agg(F.sum(F.col("weight").cast("double")).alias("weight"))
        weighted = sizes.join(given.filter("weight > 0"), F.col("of_source").eqNullSafe(F.col("given_source")))
    known = weighted.agg(F.count(F.lit(1)).alias("sources"), F.sum("weight").alias("weight")).first()
    total = target_rows if target_rows is not None else sizes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    rate = F.col("weight") / F.lit(known["weight"] or 1.0) * F.lit(float(total)) / F.col("rows")
    rates = (
        weighted.withColumn("rate", rate)
        .withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_RATE)).cast("int"))
        .select("of_source", F.struct("parts", _distribution(F.col("rate") / F.col("parts")).alias("sums")).alias("law"))
    )

    own = {"copy", "n_copies", "order_key"}
    columns = [c for c in documents.columns if c.lower() not in own]
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit(""))
    packed = documents.select(F.struct(*columns).alias("row"), F.col("source").alias("own_source"), name.alias("name"))
    same = F.col("own_source").eqNullSafe(F.col("of_source"))
    if known["sources"] <= BROADCAST_SOURCES:
        joined = packed.join(F.broadcast(rates), same)
    else:
        salted = rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = packed.withColumn("own_salt", F.pmod(F.xxhash64("name"), F.lit(SALTS))).join(
            salted, same & (F.col("own_salt") == F.col("salt"))
        )
    hashes = F.transform(
        F.sequence(F.lit(1), F.col("law.parts")), lambda part: _uniform(F.lit(str(seed)), "name", part.cast("string"))
    )
    drawn = F.aggregate(
        hashes, F.lit(0), lambda sum_, u: sum_ + F.size(F.filter(F.col("law.sums"), lambda below: below <= u))
    )
    copies = (
        joined.withColumn("n_copies", drawn)
        .filter("n_copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
        .withColumn("order_key", F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), "name", F.col("copy").cast("string"))))
    )
    return (
        copies.select(*(F.col("row")[c].alias(c) for c in columns), "copy", "n_copies", "order_key")
        .repartition("order_key")
        .sortWithinPartitions("order_key")
    )
