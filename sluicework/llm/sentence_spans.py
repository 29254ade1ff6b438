"""Removes passages that repeat, found as runs of consecutive sentences.

At every sentence starts, and at every sentence ends, the shortest run of at least
``MIN_SENTENCES`` sentences and ``MIN_WORDS`` words; what it holds depends on the text
after its start or before its end alone. Together they cover all that longer runs hold.
Runs are hashed and compared over all documents. Sentences in any run but the first of
its hash are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.llm.tasks import map_arrow, packed_out, release_memory
from sluicework.llm.words import mixed
from sluicework.sources.scratch import shuffles_freed, written_out

MIN_SENTENCES = 2
MIN_WORDS = 20

#: A sentence of up to 23 words is whole. From so many words after the end of a sentence to
#: so many before the next, a text is also cut after the word of the least hash among every
#: CUT_WINDOW words: a cut depends on the words beside it alone, so the same long run of
#: words without an end is cut alike in all documents, but for some words at its bounds.
#: The start of a text is no end: a passage there is cut as it is elsewhere.
WHOLE_WORDS = 20
LAST_WORDS = 4
CUT_WINDOW = 6

#: Full-width marks end a sentence without white space after them.
_WIDE_STOP = r"[。！？｡．]+[\"'”’)\]」』）】》]*\s*"
_STOPS = re.compile(r"[.!?]+[\"'”’)\]]*\s+|" + _WIDE_STOP)
_BREAKS = re.compile(r"\n\s*")
_WORD = re.compile(r"\S+\s*")

#: Letters of scripts without spaces (Thai to Lao, Myanmar, Khmer, kana, Han): each is a word.
_DENSE = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff"
_WIDE = "。！？｡．"
_HAS_DENSE = re.compile(f"[{_DENSE}{_WIDE}]")
_DENSE_WORD = re.compile(rf"[{_DENSE}]\s*|{_WIDE_STOP}|[^\s{_DENSE}{_WIDE}]+\s*")
_STEP = 0x9E3779B97F4A7C15
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)


def _words(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Of each word its hash and the place in the text where the next one starts."""
    if text.isascii() or not _HAS_DENSE.search(text):
        found, words = _WORD.findall(text), text.lower().split()
    else:
        found = _DENSE_WORD.findall(text)
        words = [word.strip().lower() for word in found]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return hashes, np.cumsum(lengths) + (len(text) - lengths.sum())


def _at(pattern: re.Pattern, text: str, ends: np.ndarray) -> np.ndarray:
    """Whether a match ends where a word with its white space does."""
    closed = np.zeros(len(ends), bool)
    places = np.array([m.end() for m in pattern.finditer(text)], np.int64)
    closed[np.searchsorted(ends, places[places >= ends[0]])] = True
    return closed


def _cuts(text: str, hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers of words before the end of each piece, in ascending order."""
    count = len(hashes)
    if not count:
        return np.zeros(0, np.int64)
    closed = _at(_STOPS, text, ends)
    closed[-1] = True
    number = np.arange(count)
    stops = np.flatnonzero(closed)
    following = np.searchsorted(stops, number)
    before = np.where(following > 0, stops[following - 1], -count - WHOLE_WORDS)
    inner = np.flatnonzero((number - before >= WHOLE_WORDS) & (stops[following] - number >= LAST_WORDS))
    if len(inner) and count >= CUT_WINDOW:
        # Least of a window is what is not above the largest of its windows' least values.
        value = mixed(hashes)
        windows = np.lib.stride_tricks.sliding_window_view(value, CUT_WINDOW).min(1)
        padded = np.concatenate([np.zeros(CUT_WINDOW - 1, np.uint64), windows, np.zeros(CUT_WINDOW - 1, np.uint64)])
        bound = np.lib.stride_tricks.sliding_window_view(padded, CUT_WINDOW).max(1)
        closed[inner[value[inner] <= bound[inner]]] = True
    # Line breaks end pieces too but move no other cut: a text wrapped in another way keeps those.
    closed |= _at(_BREAKS, text, ends)
    return np.flatnonzero(closed) + 1


def sentences(text: str) -> list[str]:
    """The text in pieces, each with the white space after it; joined they are the text."""
    hashes, ends = _words(text)
    if not len(ends):
        return [text] if text else []
    places = [0, *ends[_cuts(text, hashes, ends) - 1].tolist()]
    return [text[a:b] for a, b in zip(places, places[1:], strict=False)]


def _powers(base: int, count: int) -> np.ndarray:
    values = np.full(count, base, np.uint64)
    if count:
        values[0] = 1
    return np.cumprod(values, dtype=np.uint64)


def runs(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each run its hash, first sentence, number of sentences, and where it starts and ends in the text."""
    hashes, ends = _words(text or "")
    before = np.concatenate([[0], _cuts(text or "", hashes, ends)])
    count = len(before) - 1
    number = np.arange(count + 1)
    # The number of sentences by which the words suffice, and at least the least number.
    end = np.maximum(np.searchsorted(before, before + MIN_WORDS, "left"), number + MIN_SENTENCES)
    first = np.minimum(np.searchsorted(before, before - MIN_WORDS, "right") - 1, number - MIN_SENTENCES)
    starting, ending = end <= count, first >= 0
    # Many runs are the shortest from either side.
    first, end = np.divmod(
        np.unique(np.concatenate([number[starting] * (count + 1) + end[starting], first[ending] * (count + 1) + number[ending]])),
        count + 1,
    )
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_STEP, len(hashes)), dtype=np.uint64)])
    start, stop = before[first], before[end]
    run = (total[stop] - total[start]) * _powers(_STEP_INVERSE, len(hashes) + 1)[start]
    places = np.concatenate([[0], ends])
    return mixed(run + (stop - start).astype(np.uint64)).view(np.int64), first, end - first, places[start] * (start > 0), places[stop]


def _all_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs with the bounds of their sentences in the text: sentence and character in one number."""
    for batch in batches:
        found = [runs(text) for text in batch.column("text").to_pylist()]
        rows = np.repeat(np.arange(batch.num_rows), [len(f[0]) for f in found])
        if len(rows):
            hashes, first, length, start, end = (np.concatenate(part) for part in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes),
                    batch.column("doc_id").take(pa.array(rows)),
                    batch.column("text_hash").take(pa.array(rows)),
                    pa.array((first << _BITS) | start),
                    pa.array((first + length << _BITS) | end),
                ],
                ["run", "doc_id", "text_hash", "first", "last"],
            )


#: Bits of the character in a bound.
_BITS = 32


def _covered(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the union of spans."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    opens = np.concatenate([[True], first[1:] > reach[:-1]])
    return first[opens], reach[np.append(np.flatnonzero(opens)[1:] - 1, len(reach) - 1)]


def _without(texts: pa.Array, firsts: pa.Array, lasts: pa.Array) -> pa.Array:
    """Texts without the spans, and the number of sentences in these. Only texts with spans are opened."""
    has = np.asarray(firsts.is_valid().to_numpy(zero_copy_only=False), bool)
    kept, removed = [], np.zeros(len(texts), np.int32)
    for i in np.flatnonzero(has).tolist():
        text = texts[i].as_py()
        first, last = _covered(np.asarray(firsts[i].values), np.asarray(lasts[i].values))
        removed[i] = ((last >> _BITS) - (first >> _BITS)).sum()
        start, end = (first & ((1 << _BITS) - 1)).tolist(), (last & ((1 << _BITS) - 1)).tolist()
        kept.append("".join(text[a:b] for a, b in zip([0, *end], [*start, len(text)], strict=True)))
    texts = pc.replace_with_mask(texts, pa.array(has), pa.array(kept, texts.type))
    release_memory()
    return pa.StructArray.from_arrays([texts, pa.array(removed)], ["text", "removed"])


def remove_repeated_spans(documents: DataFrame) -> DataFrame:
    """The documents, their texts without passages that an earlier place holds.

    Needs ``doc_id`` and ``text``; all columns are returned, and ``removed_sentences``
    (a column of that name is replaced). Places are ordered by doc_id, null last, then
    by a hash of the text, then by position; the first place of a passage keeps it.

    Null texts stay null, texts of which all is removed become empty, no row is
    dropped. Rows with equal doc_id and text are one document and lose the same
    sentences. A text of one short sentence has no run and stays. An empty table gives
    no rows.
    """
    # Names that no column of the input clashes with.
    taken = {c.lower() for c in documents.columns}
    key_id, key_hash, firsts, lasts, result = (
        next(n for n in (f"{name}{'_' * i}" for i in range(len(taken) + 1)) if n not in taken)
        for name in ("key_id", "key_hash", "firsts", "lasts", "result")
    )
    keyed = documents.withColumn(key_id, F.col("doc_id").cast("long")).withColumn(key_hash, F.xxhash64("text"))
    texts = keyed.select(F.col(key_id).alias("doc_id"), F.col(key_hash).alias("text_hash"), F.col("text").cast("string").alias("text"))
    with shuffles_freed(documents.sparkSession):
        # Written once, as both sides of the joins are: Spark can then split a run that very many documents hold.
        found = packed_out(
            map_arrow(texts.filter("text IS NOT NULL"), _all_runs, "run long, doc_id long, text_hash long, first long, last long")
        )
        repeated = written_out(found.groupBy("run").count().filter("count > 1").select("run"))
        places = packed_out(found.join(repeated, "run"))
        place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "first")
        first = written_out(places.groupBy("run").agg(F.min(place).alias("first_place")))
    later = (
        places.join(first, "run")
        .filter(place != F.col("first_place"))
        .groupBy(F.col("doc_id").alias(key_id), F.col("text_hash").alias(key_hash))
        .agg(F.collect_list("first").alias(firsts), F.collect_list("last").alias(lasts))
    )
    same = keyed[key_id].eqNullSafe(later[key_id]) & (keyed[key_hash] == later[key_hash])
    without = F.arrow_udf(_without, "text string, removed int")
    joined = keyed.join(later, same, "left").select(*(keyed[c] for c in documents.columns), later[firsts], later[lasts])
    return joined.withColumn(result, without(F.col("text").cast("string"), firsts, lasts)).select(
        *(F.col(f"{result}.text").alias("text") if c.lower() == "text" else c for c in documents.columns if c.lower() != "removed_sentences"),
        F.col(f"{result}.removed").alias("removed_sentences"),
    )
