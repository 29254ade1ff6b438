"""Flattening and pivoting of nested documents.

The schema is walked once on the driver; what comes out is a chain of
projections and generators.  Runs of structs cost one projection however deep
they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from sluicework.functions.text import array_to_string
from sluicework.operators.schema import column

EXPLODE = "explode"
STRING = "string"


@dataclass(frozen=True)
class Pivot:
    """Flatten policy: turn an array of structs into columns named by ``key``."""

    key: str
    values: tuple | None = None


def explode_column(df: DataFrame, name: str) -> DataFrame:
    """One row per element, in place; null and empty arrays keep their row."""
    return df.select(
        *[
            F.explode_outer(column(c)).alias(c) if c == name else column(c)
            for c in df.columns
        ]
    )


def array_column_to_string(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, array_to_string(column(name)))


def _check_names(df: DataFrame, names: Sequence[str]) -> None:
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    seen: set[str] = set()
    for name in names:
        folded = name if exact else name.lower()
        if folded in seen:
            raise ValueError(f"flattening gives two columns named {name!r}")
        seen.add(folded)


def _children(name: str, kind: StructType, value: Column) -> list[tuple[Column, StructField]]:
    return [
        (value.getField(f.name), StructField(f"{name}_{f.name}", f.dataType)) for f in kind.fields
    ]


def _select(df: DataFrame, parts: Sequence[tuple[Column, StructField]]) -> DataFrame:
    _check_names(df, [f.name for _, f in parts])
    return df.select(*[value.alias(f.name) for value, f in parts])


def flatten(
    df: DataFrame, columns: Sequence[str] | None = None, max_arrays: int | None = None
) -> DataFrame:
    """Expand structs to ``parent_child`` columns and explode arrays until none is left.

    Null and empty arrays keep their row, several arrays multiply rows, maps stay
    as they are.  Per level the order is plain columns, struct members, arrays.
    ``max_arrays`` bounds how many arrays may be exploded in all.
    """
    if columns is not None:
        df = df.select(*columns)
    exploded = 0
    while any(isinstance(f.dataType, (StructType, ArrayType)) for f in df.schema.fields):
        fields = df.schema.fields
        plain = [
            (column(f.name), f)
            for f in fields
            if not isinstance(f.dataType, (StructType, ArrayType))
        ]
        members = [
            part
            for f in fields
            if isinstance(f.dataType, StructType)
            for part in _children(f.name, f.dataType, column(f.name))
        ]
        arrays = [(column(f.name), f) for f in fields if isinstance(f.dataType, ArrayType)]
        exploded += len(arrays)
        if max_arrays is not None and exploded > max_arrays:
            raise ValueError(f"flattening explodes {exploded} arrays, more than {max_arrays}")
        df = _select(df, plain + members + arrays)
        for _, f in arrays:
            df = explode_column(df, f.name)
    return df


def flatten_documents(
    df: DataFrame, arrays: Mapping[str, str | Pivot] | None = None
) -> DataFrame:
    """Flatten with one policy per array: ``"explode"``, ``"string"`` or a :class:`Pivot`.

    Arrays are named by their flattened column; those not named become strings,
    so a document stays one row unless asked otherwise.  Struct members move to
    the end.
    """
    policies = dict(arrays or {})
    parts = [(column(f.name), f) for f in df.schema.fields]
    while True:
        at = next(
            (
                i
                for i, (_, f) in enumerate(parts)
                if isinstance(f.dataType, (StructType, ArrayType))
            ),
            None,
        )
        if at is None:
            return _select(df, parts)
        value, field = parts[at]
        if isinstance(field.dataType, StructType):
            parts = parts[:at] + parts[at + 1 :] + _children(field.name, field.dataType, value)
            continue
        policy = policies.get(field.name, STRING)
        if policy == STRING:
            parts[at] = (array_to_string(value), StructField(field.name, StringType()))
            continue
        df = _select(df, parts)
        if isinstance(policy, Pivot):
            df = pivot(df, field.name, policy.key, policy.values)
        elif policy == EXPLODE:
            df = explode_column(df, field.name)
        else:
            raise ValueError(f"unknown policy {policy!r} for array {field.name!r}")
        parts = [(column(f.name), f) for f in df.schema.fields]


def policies_of(array_info: Sequence[Mapping[str, str]] | None) -> dict[str, str | Pivot]:
    """Array policies of ``[{"array_col": .., "pivot_col"?: ..}]`` entries."""
    return {
        entry["array_col"]: Pivot(entry["pivot_col"]) if "pivot_col" in entry else EXPLODE
        for entry in array_info or ()
    }


def pivot_keys(df: DataFrame, array_col: str, pivot_col: str, null_key: bool = False) -> list:
    """Distinct keys of an array of structs, sorted: the one job a pivot may need."""
    cap = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    explode = F.explode_outer if null_key else F.explode
    found = (
        df.select(explode(column(array_col).getField(pivot_col)).alias("key"))
        .distinct()
        .limit(cap + 2)
        .collect()
    )
    keys = [row["key"] for row in found if row["key"] is not None]
    if len(keys) > cap:
        raise ValueError(f"{array_col}.{pivot_col} has more than {cap} keys to pivot on")
    return sorted(keys) + ([None] if null_key and len(keys) < len(found) else [])


def pivot(
    df: DataFrame,
    array_col: str,
    pivot_col: str,
    values: Sequence | None = None,
    null_key: bool = False,
    distinct_rows: bool = False,
) -> DataFrame:
    """Turn an array of structs into columns, one per key and remaining field.

    Columns are called after the key if the struct has one other field, else
    ``key_field``.  A key that repeats takes its first element.  Rows that agree
    in all other columns merge; state ``distinct_rows`` where there are none, and
    the pivot is a projection without a shuffle.  ``values`` saves the job that
    discovers the keys, ``null_key`` keeps the column of null keys.

    Elements are looked up inside their row, so rows are never multiplied.
    """
    element = df.schema[array_col].dataType.elementType
    fields = [f.name for f in element.fields if f.name != pivot_col]
    if values is None:
        values = pivot_keys(df, array_col, pivot_col, null_key)
    main = [c for c in df.columns if c != array_col]
    array = column(array_col)
    keys = array.getField(pivot_col)

    def first_place(value) -> Column:
        if value is None:
            return F.array_position(F.transform(keys, F.isnull), F.lit(True))
        return F.array_position(keys, F.lit(value).cast(element[pivot_col].dataType))

    def name(value, field: str) -> str:
        key = "null" if value is None else str(value)
        key = key.lower() if isinstance(value, bool) else key
        return key if len(fields) == 1 else f"{key}_{field}"

    found, outputs = [], []
    for i, value in enumerate(values):
        place = first_place(value)
        item = F.get(array, (place - 1).cast("int"))
        ranked = F.when(
            place > 0,
            F.struct(place.alias("place"), *[item.getField(f).alias(f) for f in fields]),
        )
        found.append(ranked.alias(f"__p{i}"))
        outputs += [F.col(f"__p{i}").getField(f).alias(name(value, f)) for f in fields]
    wide = df.select(*map(column, main), *found)
    if not distinct_rows:
        # The least struct is the first element; content settles equal places.
        merged = [F.min(f"__p{i}").alias(f"__p{i}") for i in range(len(found))]
        wide = (
            wide.groupBy(*map(column, main)).agg(*merged)
            if merged
            else wide.distinct()
        )
    return wide.select(*map(column, main), *outputs)
