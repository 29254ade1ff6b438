"""String, digest and predicate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluicework.functions.timefn import as_column

# Digest lengths SHA-2 defines; 0 stands for 256.
SHA2_BITS = (0, 224, 256, 384, 512)


def array_to_string(array: Column | str) -> Column:
    """String form of an array without ``[``, ``]`` and ``"``, also inside values."""
    return F.translate(as_column(array).cast("string"), '[]"', "")


def sha256_hash(value: Column | str, bits: int = 256) -> Column:
    """Hex SHA-2 digest; null stays null."""
    if bits not in SHA2_BITS:
        raise ValueError(f"SHA-2 has no {bits}-bit digest, expected one of {SHA2_BITS}")
    return F.sha2(as_column(value).cast("string"), bits)


def hash_pii(value: Column | str) -> Column:
    return sha256_hash(value)


def not_null(value: Column | str) -> Column:
    return as_column(value).isNotNull()


def equals_ci(value: Column | str, expected: str) -> Column:
    """Equality that ignores the case of both sides."""
    return F.lower(as_column(value)) == expected.lower()
