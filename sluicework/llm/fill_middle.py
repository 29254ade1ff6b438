"""Fill-in-the-middle by rotating blocks of a text in place.

A scan finds where the tokens of a text end; two cuts make prefix, middle and suffix.
Sentinels are inserted in a byte buffer in the order of the text, then the block that
ends with the suffix is rotated: each of its two parts is reversed, then the whole. The
way back finds the sentinels, rotates the other way and takes the sentinels out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.llm.tasks import map_arrow

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
MARK = len(PREFIX)

#: Shares in percent: texts that are changed, and of these the ones with the suffix first.
CHANGED_PERCENT = 50
SPM_PERCENT = 80
SEED = 42

#: Bytes exchanged at a time by a reversal, and bytes of results in a batch.
SWAP_BYTES = 1 << 16
BATCH_BYTES = 8 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def token_ends(text: bytes) -> np.ndarray:
    """Where tokens end: after each run of other bytes than white space, and after
    white space at the end of the text. All white space is ASCII, so bytes will do."""
    if not text:
        return np.zeros(0, np.int64)
    space = _SPACE[np.frombuffer(text, np.uint8)]
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(text))


def code_points(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes: those that continue none."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def reverse(data: np.ndarray) -> None:
    """Reverses in place, with a bounded number of bytes beside it."""
    low, high = 0, len(data)
    while high - low > 1:
        size = min(SWAP_BYTES, (high - low) // 2)
        held = data[low : low + size].copy()
        data[low : low + size] = data[high - size : high][::-1]
        data[high - size : high] = held[::-1]
        low, high = low + size, high - size


def rotate(data: np.ndarray, first: int) -> None:
    """Exchanges the first ``first`` bytes with the others, in place, by three reversals."""
    reverse(data[:first])
    reverse(data[first:])
    reverse(data)


def transformed(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The text with sentinels, cut at the bytes ``first`` and ``second``."""
    buffer = bytearray(text)
    if form == "plain":
        return buffer
    for at, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = mark
    # Prefix, middle, suffix; in psm the middle goes behind the suffix, in spm both others do.
    start = first + MARK if form == "psm" else 0
    rotate(np.frombuffer(buffer, np.uint8)[start:], second + 2 * MARK - start)
    return buffer


def restored(output: bytes, form: str) -> bytes:
    """The text that :func:`transformed` made ``output`` of."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    # Behind the suffix with its sentinel, which leads the rotated block.
    start = 0 if form == "spm" else buffer.index(SUFFIX)
    behind = buffer.index(PREFIX if form == "spm" else MIDDLE) - start
    rotate(np.frombuffer(buffer, np.uint8)[start:], behind)
    middle = buffer.index(MIDDLE)
    suffix = buffer.index(SUFFIX)
    for at in (suffix, middle, 0):
        del buffer[at : at + MARK]
    return bytes(buffer)


def _drawn(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _planned(text: bytes, doc_id: int | None, changed: int, spm: int, seed: int) -> tuple[int, int, int, str]:
    """Number of tokens, the two cuts in bytes, and the form."""
    ends = token_ends(text)
    h1, h2, h3, h4 = _drawn(doc_id, seed)
    cuts = np.concatenate([[0], ends])
    first, second = sorted((h1 % len(cuts), h2 % len(cuts)))
    form = "spm" if h4 % 100 < spm else "psm"
    if not text or h3 % 100 >= changed or any(mark in text for mark in SENTINELS):
        form = "plain"
    return len(ends), int(cuts[first]), int(cuts[second]), form


_NAMES = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows whose last value is bytes, in batches of bounded size."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)

    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size >= BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _transform(changed: int, spm: int, seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for doc_id, cell in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = cell.as_py() or b""
                n, first, second, form = _planned(text, doc_id, changed, spm, seed)
                chars = np.frombuffer(text, np.uint8)
                sizes = (None, None) if form == "plain" else (code_points(chars[:first]), code_points(chars[first:second]))
                yield doc_id, n, form, *sizes, transformed(text, first, second, form)

    return lambda batches: _batches(rows(batches), _NAMES, _TYPES)


def fill_in_middle(
    documents: DataFrame, changed_percent: int = CHANGED_PERCENT, spm_percent: int = SPM_PERCENT, seed: int = SEED
) -> DataFrame:
    """Every text as training text of a model that fills in a middle.

    Takes ``doc_id`` and ``text``; other columns are ignored. Returns one row per input
    row: ``doc_id``, ``n`` (tokens: a word with the white space before it, or white space
    at the end), ``form`` (``plain``, ``psm`` or ``spm``), ``prefix_chars``,
    ``middle_chars`` (code points, null if plain) and ``output``. Cuts and form depend on
    ``seed`` and doc_id alone.

    A null text is an empty one; empty texts and texts that hold a sentinel stay as they
    are, as form ``plain``. A null doc_id draws as an empty one. Repeated rows give equal
    rows, long texts are taken whole, an empty table gives no rows.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.col("text").cast("string"), "UTF-8").alias("text"))
    found = map_arrow(
        rows,
        _transform(changed_percent, spm_percent, seed),
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary",
    )
    return found.withColumn("output", F.col("output").cast("string"))


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    others = []

    def texts(batch: pa.RecordBatch) -> Iterator[tuple]:
        columns = [batch.column(c).to_pylist() for c in others]
        for *kept, form, cell in zip(*columns, batch.column("form").to_pylist(), batch.column("output"), strict=True):
            yield *kept, restored(cell.as_py() or b"", form)

    for batch in batches:
        others = [c for c in batch.schema.names if c not in ("form", "output")]
        types = [batch.schema.field(c).type for c in others]
        yield from _batches(texts(batch), [*others, "text"], [*types, pa.binary()])


def restore(outputs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` and ``text``, rebuilt from the columns ``output`` and ``form`` alone.

    A null output is an empty text, a null form is plain. One row per input row.
    """
    kind = outputs.schema[key].dataType.simpleString()
    rows = outputs.select(key, F.coalesce("form", F.lit("plain")).alias("form"), F.encode("output", "UTF-8").alias("output"))
    return map_arrow(rows, _restore, f"`{key}` {kind}, text binary").withColumn("text", F.col("text").cast("string"))
