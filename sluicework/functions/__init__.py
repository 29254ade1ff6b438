"""Column expressions: all built-in functions, no Python UDF."""

from sluicework.functions.text import (
    array_to_string,
    equals_ci,
    hash_pii,
    not_null,
    sha256_hash,
)
from sluicework.functions.timefn import (
    age_in_years,
    any_epoch_to_ist,
    convert_timezone,
    epoch_to_ist,
    epoch_to_timestamp,
    java_pattern,
    string_to_ist,
    string_to_timestamp,
    utc_to_ist,
    year_frac,
    year_text,
)

__all__ = [
    "age_in_years",
    "any_epoch_to_ist",
    "array_to_string",
    "convert_timezone",
    "epoch_to_ist",
    "epoch_to_timestamp",
    "equals_ci",
    "hash_pii",
    "java_pattern",
    "not_null",
    "sha256_hash",
    "string_to_ist",
    "string_to_timestamp",
    "utc_to_ist",
    "year_frac",
    "year_text",
]
