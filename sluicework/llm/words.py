"""Words and word shingles of whole texts, as hashes."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def words_of(text: str | None) -> list[bytes]:
    """A-Z in lower case, cut at the bytes x20 and x09-x0D; null has no words."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = (values ^ (values >> _SHIFT)) * _MULTIPLIER
    values = (values ^ (values >> _SHIFT)) * _MULTIPLIER
    return values ^ (values >> _SHIFT)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for every run of ``size`` values."""
    count = len(hashes) - size + 1
    total = hashes[:count].copy()
    for start in range(1, size):
        total = total * _MULTIPLIER + hashes[start : start + count]
    return mixed(total)


def shingle_set(hashes: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct shingles in ascending order; fewer words than ``size`` make one shingle."""
    if not len(hashes):
        return hashes
    return np.unique(window_hashes(hashes, min(size, len(hashes))))
