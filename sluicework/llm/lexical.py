"""Ranked lexical search in an index stratified by document length.

A shard of the index holds documents in the order of their length, and for each term its
documents and how often they have it. Documents of one normaliser m are a stratum. Within
a stratum a term's postings are in the order of their frequency tf, and what a term adds
to a score, its impact, depends on m and tf alone, so it is computed once for each. The
largest impacts of a query's terms bound all scores of a stratum; strata are visited from
the highest bound down, until none can hold a better document than those found.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.llm.shards import beside_shards, merged
from sluicework.llm.tasks import map_arrow
from sluicework.sources.scratch import written_apart, written_out

#: Occurrences of terms in a shard, and queries in a block.
SHARD_TERMS = 2_000_000
QUERY_ROWS = 256

#: Strata of a query's first visit; each visit takes twice as many as the one before.
FIRST_STRATA = 4

# The weights and the normaliser of the contract.
WEIGHT_SCALE = 1000
IMPACT_SCALE = 1_000_000_000
TF_SCALE = 1000
M_SCALE = 12
M_BASE = 75
M_SLOPE = 25

#: ASCII letters in lower case; ASCII that is neither letter nor digit parts terms.
_FOLDED = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

_INDEX = (
    "doc_count long, term_count long, doc_ids array<long>, sizes array<long>, "
    "terms array<long>, df array<int>, docs array<int>, tf array<int>"
)


def term_counts(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of the terms of a text, and how often it has each."""
    counts = Counter(text.translate(_FOLDED).split()) if text else {}
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), np.uint64, len(counts))
    return hashes.view(np.int64), np.fromiter(counts.values(), np.int64, len(counts))


def _list(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _shard(held: list[tuple]) -> pa.RecordBatch:
    ids, hashes, counts = zip(*held, strict=True)
    sizes = np.array([c.sum() for c in counts])
    order = np.argsort(sizes, kind="stable")
    # Postings come document by document in that order; a stable sort by term keeps it.
    docs = np.repeat(np.arange(len(order)), [len(hashes[i]) for i in order])
    terms = np.concatenate([hashes[i] for i in order])
    tf = np.concatenate([counts[i] for i in order])
    by_term = np.argsort(terms, kind="stable")
    terms = terms[by_term]
    starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([len(order)], pa.int64()),
            pa.array([int(sizes.sum())], pa.int64()),
            pa.array([[ids[i] for i in order]], pa.list_(pa.int64())),
            _list(sizes[order], pa.int64()),
            _list(terms[starts], pa.int64()),
            _list(np.diff(np.append(starts, len(terms))).astype(np.int32), pa.int32()),
            _list(docs[by_term].astype(np.int32), pa.int32()),
            _list(tf[by_term].astype(np.int32), pa.int32()),
        ],
        ["doc_count", "term_count", "doc_ids", "sizes", "terms", "df", "docs", "tf"],
    )


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for doc_id, cell in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            hashes, counts = term_counts(cell.as_py())
            if not len(hashes):
                continue
            held.append((doc_id, hashes, counts))
            size += int(counts.sum())
            if size >= SHARD_TERMS:
                yield _shard(held)
                held, size = [], 0
    if held:
        yield _shard(held)


def _bytes(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).cast("long").alias(key), F.encode(F.col("text").cast("string"), "UTF-8").alias("text"))


def build_index(documents: DataFrame) -> DataFrame:
    """The index of all documents that have a term, one row per shard, as a written table.

    Takes ``doc_id`` and ``text``. Shards are made where documents are read, so nothing
    is shuffled; ``sizes`` (terms of a document, ascending), ``docs`` and ``tf`` (postings
    of all ``terms``, ``df`` of each) say all that a search needs. However many shards a
    task makes or reads, it holds one.
    """
    shards = map_arrow(_bytes(documents, "doc_id"), _shards, _INDEX)
    return written_apart(shards.withColumn("block", F.monotonically_increasing_id()))


@dataclass(frozen=True)
class Queries:
    """Queries by row, with the numbers of their terms and what an impact of each counts."""

    keys: np.ndarray
    ids: list
    terms: np.ndarray
    starts: np.ndarray
    numbers: np.ndarray
    weights: np.ndarray


class StratifiedShard:
    """A shard of the index, cut into strata by N documents and L terms of the whole corpus."""

    def __init__(self, row: dict, documents: int, terms: int) -> None:
        self.ids = np.array([0 if i is None else i for i in row["doc_ids"]], np.int64)
        self.unnamed = np.array([i is None for i in row["doc_ids"]], bool)
        m = M_BASE + (M_SLOPE * row["sizes"] * documents) // terms
        first = np.concatenate([[True], m[1:] != m[:-1]])
        self.m = m[first]
        self.stratum = np.cumsum(first) - 1
        self._terms, self._docs, self._tf = row["terms"], row["docs"], row["tf"]
        self._starts = np.concatenate([[0], np.cumsum(row["df"], dtype=np.int64)])

    def _postings(self, terms: np.ndarray) -> None:
        """Postings of these terms by stratum and tf, and the groups of one term and stratum."""
        at = np.minimum(np.searchsorted(self._terms, terms), len(self._terms) - 1)
        known = np.flatnonzero(self._terms[at] == terms)
        at = at[known]
        counts = self._starts[at + 1] - self._starts[at]
        chosen = _ranges(self._starts[at], counts)
        docs, tf, term = self._docs[chosen], self._tf[chosen].astype(np.int64), np.repeat(known, counts)
        stratum = self.stratum[docs]
        order = np.lexsort((-tf, stratum, term))
        docs, tf, term, stratum = docs[order], tf[order], term[order], stratum[order]
        group = _changes(term, stratum)
        run = group | _changes(tf)
        runs = np.flatnonzero(run)
        impact = (IMPACT_SCALE * tf[runs]) // (TF_SCALE * tf[runs] + M_SCALE * self.m[stratum[runs]])
        self.docs, self.impact = docs, np.repeat(impact, np.diff(np.append(runs, len(docs))))
        starts = np.flatnonzero(group)
        self.group_start, self.group_count = starts, np.diff(np.append(starts, len(docs)))
        self.group_stratum, self.group_top = stratum[starts], self.impact[starts]
        self.of_term = np.searchsorted(term[starts], np.arange(len(terms) + 1))

    def search(self, queries: Queries, k: int) -> Iterator[tuple[int, list]]:
        """Of each query its row and the best documents: (score, doc_id)."""
        self._postings(queries.terms)
        for row in range(len(queries.keys)):
            own = slice(queries.starts[row], queries.starts[row + 1])
            found, scores = self._best(queries.numbers[own], queries.weights[own], k)
            if len(found):
                yield row, [(int(s), None if self.unnamed[d] else int(self.ids[d])) for d, s in zip(found, scores, strict=True)]

    def _best(self, numbers: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        groups = [slice(self.of_term[n], self.of_term[n + 1]) for n in numbers]
        bounds = np.zeros(len(self.m), np.int64)
        for own, weight in zip(groups, weights, strict=True):
            bounds[self.group_stratum[own]] += weight * self.group_top[own]
        order = np.argsort(-bounds, kind="stable")
        bounds = bounds[order]
        scores = np.zeros(len(self.ids), np.int64)
        least, at, step = 1, 0, FIRST_STRATA
        self.visited = 0
        while at < len(order) and bounds[at] >= least:
            chosen = order[at : at + step][bounds[at : at + step] >= least]
            is_chosen = np.zeros(len(self.m), bool)
            is_chosen[chosen] = True
            for own, weight in zip(groups, weights, strict=True):
                here = np.flatnonzero(is_chosen[self.group_stratum[own]]) + own.start
                posting = _ranges(self.group_start[here], self.group_count[here])
                scores[self.docs[posting]] += weight * self.impact[posting]
            at, step = at + step, 2 * step
            self.visited += len(chosen)
            found = np.flatnonzero(scores > 0)
            if len(found) >= k:
                least = max(1, int(np.partition(scores[found], len(found) - k)[len(found) - k]))
        found = np.flatnonzero(scores >= least)
        best = np.lexsort((self.ids[found], self.unnamed[found], -scores[found]))[:k]
        return found[best], scores[found[best]]


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    changed = np.zeros(len(columns[0]), bool)
    changed[:1] = True
    for column in columns:
        changed[1:] |= column[1:] != column[:-1]
    return changed


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [term_counts(cell.as_py()) for cell in batch.column("text")]
        rows = pa.array(np.repeat(np.arange(batch.num_rows), [len(h) for h, _ in found]))
        if len(rows):
            hashes, counts = (np.concatenate(part) for part in zip(*found, strict=True))
            own = [batch.column(c).take(rows) for c in ("item_key", "item_id")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(hashes), pa.array(counts)], ["item_key", "item_id", "term", "repeats"])


def _query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def block(rows: list[dict]) -> pa.RecordBatch:
        terms = [t["term"] for r in rows for t in r["weighted"]]
        weights = [t["weight"] for r in rows for t in r["weighted"]]
        values = ([r["item_key"] for r in rows], [r["item_id"] for r in rows], [len(r["weighted"]) for r in rows], terms, weights)
        return pa.RecordBatch.from_arrays([pa.array([v], pa.list_(pa.int64())) for v in values], ["keys", "ids", "lengths", "asked", "weights"])

    held = []
    for batch in batches:
        for row in batch.to_pylist():
            held.append(row)
            if len(held) >= QUERY_ROWS:
                yield block(held)
                held = []
    if held:
        yield block(held)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(batch.column(name)[0].values)


def _opened(batch: pa.RecordBatch) -> Queries:
    terms, numbers = np.unique(_column(batch, "asked"), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(_column(batch, "lengths"))])
    return Queries(_column(batch, "keys"), batch.column("ids")[0].as_py(), terms, starts, numbers, _column(batch, "weights"))


def _search(documents: int, terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = None, None
        for batch in batches:
            for row in (batch.slice(i, 1) for i in range(batch.num_rows)):
                of = row.column("shard")[0].as_py()
                if row.column("part")[0].as_py() == 0:
                    parts = {c: _column(row, c) for c in ("sizes", "terms", "df", "docs", "tf")}
                    number, shard = of, StratifiedShard(parts | {"doc_ids": row.column("doc_ids")[0].as_py()}, documents, terms)
                elif of == number:
                    queries = _opened(row)
                    found = [
                        {
                            "item_key": int(queries.keys[at]),
                            "item_id": queries.ids[at],
                            "shard": of,
                            "best": [{"order": -s, "unnamed": i is None, "doc_id": i} for s, i in best],
                        }
                        for at, best in shard.search(queries, k)
                    ]
                    yield pa.RecordBatch.from_pylist(found, schema=_FOUND)

    return run


_FOUND = pa.schema(
    [
        ("item_key", pa.int64()),
        ("item_id", pa.int64()),
        ("shard", pa.int64()),
        ("best", pa.list_(pa.struct([("order", pa.int64()), ("unnamed", pa.bool_()), ("doc_id", pa.int64())]))),
    ]
)


def search_index(index: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` documents of the index with the highest scores above 0 for each item.

    Items have ``item_id`` and ``text``. Returns ``item_id``, ``rank``, ``doc_id``,
    ``score``. Terms are compared by 64-bit hashes. A term's number of documents is summed
    over all shards, and weighted in Spark, before the search.
    """
    known = index.agg(F.sum("doc_count"), F.sum("term_count")).first()
    documents, terms = known[0] or 0, known[1] or 0
    keyed = _bytes(items, "item_id").distinct().withColumn("item_key", F.monotonically_increasing_id())
    asked = written_out(map_arrow(keyed, _terms_of, "item_key long, item_id long, term long, repeats long"))
    held = index.select(F.inline(F.arrays_zip("terms", "df"))).select(F.col("terms").alias("term"), "df")
    frequency = held.join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))
    # In doubles; everything after it in 64-bit integers.
    weight = F.floor(WEIGHT_SCALE * F.log(F.lit(2.0 * documents + 2) / (2.0 * F.col("df") + 1)))
    weighted = written_out(
        asked.join(frequency, "term")
        .withColumn("weight", weight * F.col("repeats"))
        .filter("weight > 0")
        .groupBy("item_key", "item_id")
        .agg(F.collect_list(F.struct("term", "weight")).alias("weighted"))
    )
    dealt = weighted.repartition(max(1, math.ceil(weighted.count() / QUERY_ROWS)))
    blocks = map_arrow(
        dealt, _query_blocks, "keys array<long>, ids array<long>, lengths array<long>, asked array<long>, weights array<long>"
    )
    both, shards = beside_shards(index.drop("doc_count", "term_count"), written_out(blocks.withColumn("block", F.monotonically_increasing_id())))
    lists = map_arrow(
        both,
        _search(documents, terms, k),
        "item_key long, item_id long, shard long, best array<struct<order:bigint,unnamed:boolean,doc_id:bigint>>",
    )
    return merged(lists, ["item_key", "item_id"], shards, k).select("item_id", F.posexplode("best").alias("at", "found")).select(
        "item_id",
        (F.col("at") + 1).alias("rank"),
        F.col("found.doc_id").alias("doc_id"),
        (-F.col("found.order")).alias("score"),
    )


def ranked_search(documents: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` documents with the highest scores for each item, from an index of all documents.

    Needs ``doc_id`` and ``text``, and ``item_id`` and ``text``; other columns are
    ignored. Terms are runs of ASCII letters and digits and of all characters beyond
    ASCII, A-Z in lower case. Returns ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    Null, empty and termless texts are no documents and find nothing. Long texts are
    indexed whole. Equal scores are ranked by doc_id, null last. Repeated documents are
    found once each; an item that repeats is answered once, and items that share an id
    with other texts are answered each. An empty table gives no rows.
    """
    return search_index(build_index(documents), items, k)
