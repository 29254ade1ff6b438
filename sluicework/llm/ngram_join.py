"""Jaccard self-join of word shingles by prefix filters under several token orders.

A pair that is similar enough must share a token of the prefixes of both sets under
every total order of the tokens. Three orders are used. The first, by hash, filters
rows: those stay that hold enough prefix tokens of other rows. The other two, by document
frequency and hash and by document frequency and another hash, filter pairs: both must
hold before a pair is verified on the whole sets.

Texts with the same words are one node from the start. Only what holds a component
together has to be verified: in each group of nodes that share a prefix token, all
are compared with one pivot; groups that then lie in one component are settled, and
only pairs of different components are compared in those that are left. Links inside
settled groups are neither listed nor counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.components import connected_components
from sluicework.llm.tasks import map_arrow
from sluicework.llm.words import SHINGLE_WORDS, hash_words, shingle_set, words_of
from sluicework.sources.scratch import written_out

#: Tokens that a set adds to its prefix, as a share of the set (one in so many).
EXTRA_ONE_IN = 10

#: Nodes whose keys (16 bytes and two numbers) are broadcast to the texts; more are joined.
BROADCAST_NODES = 200_000

#: Bits that tell how far two sets differ at least.
PARITY_BITS = 1024

#: Rounds in which each group is compared with one pivot.
PIVOT_ROUNDS = 2


def _least_overlap(n: np.ndarray | int, percent: int):
    return -(-n * percent // 100)


def _prefix_length(n: int, percent: int) -> int:
    return n - _least_overlap(n, percent) + 1 + n // EXTRA_ONE_IN if n else 0


def _least_shared(n: Column, percent: int) -> Column:
    """Prefix tokens that a set shares with any similar one, at least."""
    smallest = F.ceil(n * percent / 100)
    return F.floor(smallest / EXTRA_ONE_IN) + 1


def _sketch(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts, prefixes = [], [], []
            for text in batch.column("text").to_pylist():
                hashes = hash_words(words_of(text))
                tokens = shingle_set(hashes, size)
                words.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                counts.append(len(tokens))
                prefixes.append(tokens[: _prefix_length(len(tokens), percent)].view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_no"),
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(words, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), np.concatenate([np.empty(0, np.int64), *prefixes])
                    ),
                ],
                ["row_no", "doc_id", "text_key", "words", "n_shingles", "prefix"],
            )

    return run


def _parity(tokens: np.ndarray) -> np.ndarray:
    """PARITY_BITS bits; two sets differ in at least as many tokens as these in bits."""
    odd = np.bincount(tokens.astype(np.int64) & (PARITY_BITS - 1), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _whole_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(hash_words(words_of(text)), size) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([_parity(s) for s in sets], pa.list_(pa.int64())),
                ],
                ["node", "tokens", "parity"],
            )

    return run


def _similar_sizes(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _verified(pairs: DataFrame, prefixes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` that share a prefix token under the other order and are similar."""
    other = prefixes.select("node", "other")
    candidates = (
        pairs.join(other.select(F.col("node").alias("a"), F.col("other").alias("other_a")), "a")
        .join(other.select(F.col("node").alias("b"), F.col("other").alias("other_b")), "b")
        .filter(F.arrays_overlap("other_a", "other_b"))
        .select("a", "b")
    )
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    union = F.size("tokens_a") + F.size("tokens_b") - common
    return (
        candidates.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("tokens_a")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tokens_b")), "b")
        .filter(common * 100 >= union * percent)
        .select("a", "b")
    )


def _unsettled(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """Postings with their component, of tokens whose nodes lie in more than one."""
    labelled = postings.drop("component").join(labels, "node")
    open_tokens = (
        labelled.groupBy("token")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high")
        .select("token")
    )
    return labelled.join(open_tokens, "token", "left_semi")


def ngram_jaccard_components(documents: DataFrame, size: int = SHINGLE_WORDS, percent: int = 80) -> DataFrame:
    """Groups of documents linked by Jaccard similarity of at least ``percent`` / 100.

    Takes ``doc_id`` and ``text``; other columns are ignored. Returns one row per input
    row: ``doc_id``, ``text_key`` (MD5 of the text), ``n_shingles``, ``component_id``
    (smallest doc_id of the group), ``is_first`` (the row, or rows that repeat it, that
    stand for the group).

    Null and empty texts, and texts of white space, have no shingles, link with nothing
    and are their own group. Rows without a doc_id are grouped by their text like others
    and have a null component_id if no member has one. Repeated rows are members of one
    group. An empty table gives no rows. Links of texts with different words are found by
    verified pairs, exactly; equal words are compared by a 128-bit hash.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.unhex(F.md5("text")).alias("text_key"))
    sketch = written_out(
        map_arrow(
            texts.withColumn("row_no", F.monotonically_increasing_id()),
            _sketch(size, percent),
            "row_no long, doc_id long, text_key binary, words binary, n_shingles long, prefix array<long>",
        )
    )
    # A node is the first row with its words.
    of_words = sketch.filter("n_shingles > 0").groupBy("words").agg(F.min("row_no").alias("node"))

    # Order 1, by hash: nodes with enough tokens that another row has in its prefix.
    tokens = sketch.select("row_no", F.explode("prefix").alias("token"))
    repeated = tokens.groupBy("token").count().filter("count > 1").select("token")
    held = tokens.join(repeated, "token").groupBy("row_no").agg(F.count(F.lit(1)).alias("held"))
    left = written_out(
        sketch.drop("prefix", "words")
        .join(held, "row_no")
        .filter(F.col("held") >= _least_shared(F.col("n_shingles"), percent))
        .join(of_words.select(F.col("node").alias("row_no")), "row_no", "left_semi")
        .select(F.col("row_no").alias("node"), F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_text"))
    )
    if left.count() <= BROADCAST_NODES:
        left = F.broadcast(left)
    of_node = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_text"))
    sets = written_out(
        map_arrow(texts.join(left, of_node).select("node", "text"), _whole_sets(size), "node long, tokens array<long>, parity array<long>")
        .dropDuplicates(["node"])
    )

    # Orders 2 and 3, by frequency among the whole sets that are left. A token that no
    # other set has comes first in both, and is of no use but for the prefix it fills.
    tokens = sets.select("node", F.size("tokens").alias("n_shingles"), F.explode("tokens").alias("token"))
    frequency = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    least = F.ceil(F.col("n_shingles") * percent / 100)
    by_node = (
        tokens.join(frequency, "token")
        .groupBy("node", "n_shingles")
        .agg(F.collect_list(F.struct("df", "token")).alias("held"))
        .filter(F.size("held") >= least)
        .withColumn("keep", (F.size("held") - least + 1).cast("int"))
    )
    first = F.array_sort("held")
    second = F.array_sort(
        F.transform("held", lambda x: F.struct(x["df"], F.xxhash64(x["token"]).alias("by"), x["token"].alias("token")))
    )
    prefixes = written_out(
        by_node.select(
            "node",
            "n_shingles",
            (F.size("held") / F.col("n_shingles")).alias("held_share"),
            F.slice(F.transform(first, lambda x: x["token"]), F.lit(1), F.col("keep")).alias("tokens"),
            F.slice(F.transform(second, lambda x: x["token"]), F.lit(1), F.col("keep")).alias("other"),
        )
    )
    postings = prefixes.select("node", "n_shingles", "held_share", F.explode("tokens").alias("token"))
    several = postings.groupBy("token").count().filter("count > 1").select("token")
    postings = written_out(postings.join(several, "token", "left_semi"))
    nodes = postings.select("node").distinct()

    labels = nodes.withColumn("component", F.col("node"))
    links = None
    for round_number in range(PIVOT_ROUNDS + 1):
        open_postings = written_out(_unsettled(postings, labels)) if round_number else postings.withColumn("component", F.col("node"))
        if round_number and open_postings.isEmpty():
            break
        if round_number < PIVOT_ROUNDS:
            pairs = _pivot_pairs(open_postings, round_number, percent)
        else:
            pairs = _pairs_across(open_postings, sets, percent)
        found = written_out(_verified(pairs, prefixes, sets, percent))
        links = found if links is None else links.unionByName(found)
        labels = connected_components(nodes, links)
        postings = open_postings

    return _per_document(sketch, of_words, labels)


def _pivot_pairs(postings: DataFrame, round_number: int, percent: int) -> DataFrame:
    """Every posting with the pivot of its token: the node with the most shared tokens,
    in later rounds that of the component which is not the largest label's."""
    rank = F.struct(-F.col("held_share"), F.col("node"), F.col("n_shingles"))
    if round_number == 0:
        pivots = postings.groupBy("token").agg(F.min(rank).alias("pivot"))
        different = F.col("a") != F.col("b")
    else:
        high = postings.groupBy("token").agg(F.max("component").alias("high"))
        pivots = (
            postings.join(high, "token").filter("component = high").groupBy("token").agg(
                F.min(rank).alias("pivot"), F.first("high").alias("pivot_component")
            )
        )
        different = F.col("component") != F.col("pivot_component")
    return (
        postings.join(pivots, "token")
        .withColumn("a", F.col("pivot.node"))
        .withColumn("b", F.col("node"))
        .filter(different & _similar_sizes("n_shingles", "pivot.n_shingles", percent))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _pairs_across(postings: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a token, lie in different components and may be similar: similar
    sets of n and m tokens differ in (n + m)(100 - percent) / (100 + percent) at most."""
    known = written_out(postings.join(sets.select("node", "parity"), "node"))
    names = ("node", "component", "n_shingles", "parity")
    left = known.select("token", *(F.col(c).alias(f"{c}_a") for c in names))
    right = known.select("token", *(F.col(c).alias(f"{c}_b") for c in names))
    differing = F.aggregate(
        F.zip_with("parity_a", "parity_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, bits: n + bits
    )
    either = F.col("n_shingles_a") + F.col("n_shingles_b")
    return (
        left.join(right, "token")
        .filter(
            (F.col("node_a") < F.col("node_b"))
            & (F.col("component_a") != F.col("component_b"))
            & _similar_sizes("n_shingles_a", "n_shingles_b", percent)
            & (differing * (100 + percent) <= either * (100 - percent))
        )
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        .distinct()
    )


def _per_document(sketch: DataFrame, of_words: DataFrame, labels: DataFrame) -> DataFrame:
    rows = sketch.drop("prefix").join(of_words, "words", "left")
    by_node = rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    )
    by_node = by_node.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    of_component = by_node.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min("first").alias("first"))
    known = by_node.select("node", "component").join(of_component, "component").drop("component")
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    empty = F.col("n_shingles") == 0
    return rows.join(known, "node", "left").select(
        "doc_id",
        "text_key",
        "n_shingles",
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, True).otherwise(is_first).alias("is_first"),
    )
