"""Token ids of whole texts by a public tokenizer file.

Texts are cut into words in one buffer of bytes, and words are looked up by hashes in flat
arrays that a worker keeps, bounded in number. Most words are letters, with or without
marks after them: new ones get their ids by the merges of the file, many words at a time.
All other words go through the tokenizer itself.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator, Sequence

import numpy as np

from sluicework.llm.words import mixed

#: Words a worker remembers, the first it meets, and their length in bytes.
KNOWN_WORDS = 520_000
KNOWN_BYTES = 40

#: Runs of marks a worker remembers.
KNOWN_MARKS = 10_000

#: Bytes of the longest piece that is merged here, and of text that is looked up at a time.
MERGED_BYTES = 64
SEGMENT_BYTES = 1 << 18

ID_BYTES = 4

#: Letters below this are in lower case, and in NFC, one by one.
_LATIN_END = "ɐ"

_WORD_END = "</w>"

#: ASCII marks that stand alone as a piece of their own; an apostrophe may not.
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Two independent hashes of a word: random values of bytes times powers of their places.
_rng = np.random.default_rng(29)
_VALUES = _rng.integers(1, 1 << 64, (2, 256), np.uint64)
_POWERS = np.cumprod(np.full((2, KNOWN_BYTES), [[0x9E3779B97F4A7C15], [0xC2B2AE3D27D4EB4F]], np.uint64), axis=1, dtype=np.uint64)


class _Table:
    """Numbers by 64-bit keys, in open addressing: a key is at its place or behind it, before a free one."""

    def __init__(self, most: int) -> None:
        self._bits = max(4, int(2 * most).bit_length())
        self._keys = np.zeros(1 << self._bits, np.uint64)
        self._values = np.full(1 << self._bits, -1, np.int32)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Keys that are not there, each once."""
        place, left = self._place(keys), np.arange(len(keys))
        while len(left):
            _, first = np.unique(place[left], return_index=True)
            chosen = left[first]
            chosen = chosen[self._values[place[chosen]] < 0]
            self._keys[place[chosen]], self._values[place[chosen]] = keys[chosen], values[chosen]
            left = np.setdiff1d(left, chosen, assume_unique=True)
            place[left] = (place[left] + 1) & (len(self._keys) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        place = self._place(keys)
        value = self._values[place]
        open_ = np.flatnonzero((value >= 0) & (self._keys[place] != keys))
        while len(open_):
            place[open_] = (place[open_] + 1) & (len(self._keys) - 1)
            value[open_] = self._values[place[open_]]
            open_ = open_[(value[open_] >= 0) & (self._keys[place[open_]] != keys[open_])]
        return value


def _byte_names() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is
    printable, else the next one from 256 up."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class _Merges:
    """Byte-pair merges of many short pieces at a time."""

    _NONE = np.int32(2**31 - 1)

    def __init__(self, model: dict) -> None:
        vocab = model["vocab"]
        names = _byte_names()
        self._inner = np.array([vocab[n] for n in names], np.int32)
        self._last = np.array([vocab[n + _WORD_END] for n in names], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self._ranks = _Table(len(pairs))
        self._ranks.add(self._key(left, right), np.arange(len(pairs), dtype=np.int32))

    @staticmethod
    def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a.astype(np.int64) << 32) | b).astype(np.uint64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, or ``_NONE``."""
        rank = self._ranks.find(self._key(a, b))
        rank[rank < 0] = self._NONE
        return rank

    def ids(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """The ids of each piece, of 1 to MERGED_BYTES of the bytes in ``data``."""
        groups = (lengths + 3) // 4
        order = np.argsort(groups, kind="stable")
        found: list[bytes] = []
        for own in np.split(order, np.flatnonzero(np.diff(groups[order])) + 1):
            if len(own):
                symbols, counts = self._merged_group(data, starts[own], lengths[own])
                ids = symbols[np.arange(symbols.shape[1]) < counts[:, None]].astype("<u4").tobytes()
                ends = (np.cumsum(counts) * ID_BYTES).tolist()
                found += [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        at = np.empty(len(order), np.int64)
        at[order] = np.arange(len(order))
        return [found[i] for i in at.tolist()]

    def _merged_group(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width, every = int(lengths.max()), np.arange(len(starts))
        column = np.arange(width)
        padded = data[np.minimum(starts[:, None] + column, len(data) - 1)]
        symbols = self._inner[padded]
        symbols[every, lengths - 1] = self._last[padded[every, lengths - 1]]
        ranks = np.full((len(starts), width), self._NONE, np.int32)
        is_pair = column[:-1] < lengths[:, None] - 1
        ranks[:, :-1][is_pair] = self._rank(symbols[:, :-1][is_pair], symbols[:, 1:][is_pair])
        done, counts = symbols.copy(), lengths.copy()
        rows = every
        while len(rows):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            going = best != self._NONE
            if not going.all():
                done[rows[~going]] = symbols[~going]
                rows, symbols, ranks, at, best = rows[going], symbols[going], ranks[going], at[going], best[going]
            if not len(rows):
                break
            every = np.arange(len(rows))
            # What lies behind the pair moves one place to the left.
            behind = column[:-1] > at[:, None]
            np.copyto(symbols[:, :-1], symbols[:, 1:].copy(), where=behind)
            np.copyto(ranks[:, :-1], ranks[:, 1:].copy(), where=behind)
            symbols[every, at] = self._merged[best]
            counts[rows] -= 1
            last = counts[rows] - 1
            ranks[every, at] = self._NONE
            ranks[every, last] = self._NONE
            pair = np.flatnonzero(at < last)
            ranks[pair, at[pair]] = self._rank(symbols[pair, at[pair]], symbols[pair, at[pair] + 1])
            pair = np.flatnonzero(at > 0)
            ranks[pair, at[pair] - 1] = self._rank(symbols[pair, at[pair] - 1], symbols[pair, at[pair]])
        return done, counts


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


class WordTokenizer:
    """Encodes text word by word and remembers some of the words.

    For byte-level byte-pair tokenizers with a suffix at the end of a word, which put
    letters in lower case, cut them from other characters and drop white space; so a text
    has the ids of its words in a row, and a word those of its letters and its marks.
    Words are told apart by 128 bits.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, "rb") as file:
            text = file.read()
        self._tokenizer = Tokenizer.from_buffer(text)
        self._merges = _Merges(json.loads(text)["model"])
        self._mark_ids: dict[str, bytes] = {}
        self._numbers = _Table(KNOWN_WORDS)
        self._checks = np.zeros(KNOWN_WORDS, np.uint64)
        self._starts = np.zeros(KNOWN_WORDS + 1, np.int64)
        self._ids = np.zeros(1 << 16, np.uint32)
        self._count = 0
        self.size = max(self._tokenizer.get_vocab().values()) + 1

    def _whole(self, texts: list[str]) -> list[bytes]:
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(one.ids, "<u4").tobytes() for one in encoded]

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        """Ids of new words: letters and the marks after them are merged here."""
        lowered = b"\n".join(words).decode("utf-8", "replace").lower().split("\n")
        stems = [text.rstrip(_MARKS) for text in lowered]
        good = [s.isalpha() and (s.isascii() or max(s) < _LATIN_END) for s in stems]
        data = np.frombuffer("\n".join([s if g else "" for s, g in zip(stems, good, strict=True)]).encode() + b"\n", np.uint8)
        ends = np.flatnonzero(data == 10)
        starts = np.concatenate([[0], ends[:-1] + 1])
        fits = np.flatnonzero((ends > starts) & (ends - starts <= MERGED_BYTES))
        ids = self._merges.ids(data, starts[fits], (ends - starts)[fits])
        chosen, known = fits.tolist(), self._mark_ids
        marks = [lowered[i][len(stems[i]) :] for i in chosen]
        new = list(set(marks) - known.keys())
        if new:
            if len(known) > KNOWN_MARKS:
                known.clear()
                new = list(set(marks))
            known.update(zip(new, self._whole(new), strict=True))
        found: list[bytes | None] = [None] * len(words)
        for i, own, mark in zip(chosen, ids, marks, strict=True):
            found[i] = own + known[mark] if mark else own
        others = [i for i, own in enumerate(found) if own is None]
        for i, own in zip(others, self._whole([words[i].decode("utf-8", "replace") for i in others]), strict=True):
            found[i] = own
        return found

    def _remember(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        room = min(len(keys), KNOWN_WORDS - self._count)
        if room <= 0:
            return
        first, last = self._count, self._count + room
        self._numbers.add(keys[:room], np.arange(first, last, dtype=np.int32))
        self._checks[first:last] = checks[:room]
        self._starts[first + 1 : last + 1] = self._starts[first] + np.cumsum(counts[:room])
        size = int(self._starts[last])
        if size > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros(size, np.uint32)])
        self._ids[self._starts[first] : size] = ids[: size - self._starts[first]]
        self._count = last

    def _segment(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where words start, how many ids each has, and all ids."""
        codes = np.frombuffer(data, np.uint8)
        space = np.concatenate([[True], _SPACE[codes], [True]])
        edges = np.flatnonzero(space[1:] != space[:-1])
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        if not len(starts):
            return starts, lengths, np.zeros(0, np.uint32)
        short = np.minimum(lengths, KNOWN_BYTES)
        ends = np.cumsum(short)
        place = np.arange(ends[-1]) - np.repeat(ends - short, short)
        own = codes[np.repeat(starts, short) + place]
        key, check = (mixed(np.add.reduceat(_VALUES[i][own] * _POWERS[i][place], ends - short)) for i in (0, 1))
        number = self._numbers.find(key)
        known = (number >= 0) & (lengths <= KNOWN_BYTES)
        known[known] = self._checks[number[known]] == check[known]
        counts = np.zeros(len(starts), np.int64)
        at = np.zeros(len(starts), np.int64)
        counts[known] = (self._starts[1:] - self._starts[:-1])[number[known]]
        at[known] = self._starts[number[known]]
        missing = np.flatnonzero(~known)
        held = self._starts[self._count]
        pool = self._ids[:held]
        if len(missing):
            # Long words are encoded wherever they are.
            is_long = lengths[missing] > KNOWN_BYTES
            brief, long = missing[~is_long], missing[is_long]
            _, first, of_brief = np.unique(key[brief] ^ mixed(check[brief]), return_index=True, return_inverse=True)
            new = np.concatenate([brief[first], long])
            of = np.zeros(len(missing), np.int64)
            of[~is_long], of[is_long] = of_brief, len(first) + np.arange(len(long))
            ids = self._encoded([data[a : a + n] for a, n in zip(starts[new].tolist(), lengths[new].tolist(), strict=True)])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // ID_BYTES
            flat = np.frombuffer(b"".join(ids), "<u4")
            counts[missing] = sizes[of]
            at[missing] = held + (np.cumsum(sizes) - sizes)[of]
            pool = np.concatenate([pool, flat])
            # Words whose key is free.
            fit = np.flatnonzero((lengths[new] <= KNOWN_BYTES) & (number[new] < 0))
            fit = fit[np.unique(key[new][fit], return_index=True)[1]]
            self._remember(key[new][fit], check[new][fit], flat[_ranges((np.cumsum(sizes) - sizes)[fit], sizes[fit])], sizes[fit])
        return starts, counts, pool[_ranges(at, counts)]

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers; null is empty."""
        parts = [text.encode("utf-8", "replace") if text else b"" for text in texts]
        ends = np.cumsum([len(p) + 1 for p in parts])
        sizes, found = np.zeros(len(parts), np.int64), []
        for at, data in _segments(b"\n".join(parts)):
            starts, counts, ids = self._segment(data)
            np.add.at(sizes, np.searchsorted(ends, starts + at, "right"), counts)
            found.append(ids.astype("<u4").tobytes())
        whole, stops = b"".join(found), (np.cumsum(sizes) * ID_BYTES).tolist()
        return [whole[a:b] for a, b in zip([0, *stops], stops, strict=False)]


def _segments(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Parts of about SEGMENT_BYTES that end with a word, and where they start."""
    at = 0
    while at < len(data):
        end = at + SEGMENT_BYTES
        if end < len(data):
            cuts = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8, SEGMENT_BYTES, at)])
            while not len(cuts) and end < len(data):
                more = min(SEGMENT_BYTES, len(data) - end)
                cuts = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8, more, end)]) + (end - at)
                end += more
            end = at + int(cuts[-1]) + 1 if len(cuts) else len(data)
        yield at, data[at:end]
        at = end


@functools.lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)
