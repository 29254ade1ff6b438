"""Column-name repair, projections and filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.functions.text import equals_ci, not_null

NOT_NULL = "null"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col(quoted(name))


def _by_position(df: DataFrame) -> DataFrame:
    """Rename columns to ``c0, c1, ...`` so that equal names stay addressable."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def rename_duplicate_columns(df: DataFrame) -> DataFrame:
    """Lower-case all names and coalesce the columns that then collide.

    Values are taken left to right; merged columns move to the end.
    """
    places: dict[str, list[int]] = {}
    for i, name in enumerate(df.columns):
        places.setdefault(name.lower(), []).append(i)
    if len(places) == len(df.columns):
        return df.toDF(*places)
    single = [F.col(f"c{at[0]}").alias(name) for name, at in places.items() if len(at) == 1]
    merged = [
        F.coalesce(*[F.col(f"c{i}") for i in at]).alias(name)
        for name, at in places.items()
        if len(at) > 1
    ]
    return _by_position(df).select(*single, *merged)


def remove_duplicate_columns(df: DataFrame) -> DataFrame:
    """Of several columns with one name keep the last."""
    last = {name: i for i, name in enumerate(df.columns)}
    if len(last) == len(df.columns):
        return df
    kept = sorted((i, name) for name, i in last.items())
    return _by_position(df).select(*[F.col(f"c{i}").alias(name) for i, name in kept])


def filter_column(df: DataFrame, name: str, value: str) -> DataFrame:
    """Rows whose column equals ``value`` in any case; ``"null"`` asks for not-null."""
    return df.where(_predicate(name, value))


def apply_filters(df: DataFrame, entries: Iterable[Mapping[str, str]] | None) -> DataFrame:
    """Rows that satisfy every ``{"column": .., "value": ..}`` entry."""
    predicates = [_predicate(entry["column"], entry["value"]) for entry in entries or ()]
    return df.where(reduce(Column.__and__, predicates)) if predicates else df


def _predicate(name: str, value: str) -> Column:
    return not_null(column(name)) if value == NOT_NULL else equals_ci(column(name), value)


def key_overrides(entries: Iterable[Mapping[str, str]] | None) -> dict[str, str]:
    """Key fields that filter entries override; the last complete entry wins."""
    found: dict[str, str] = {}
    for entry in entries or ():
        found.update({k: entry[k] for k in ("unique_id", "incremental_key") if k in entry})
    return found


def select_with_key(
    df: DataFrame, fields: Iterable[str], unique_id: str, unique_sql: str | None = None
) -> DataFrame:
    """Mapped columns, plus the key derived by SQL where it is not among them."""
    fields = list(fields)
    chosen = [column(name) for name in fields]
    if unique_id not in fields:
        if not unique_sql:
            raise ValueError(f"key {unique_id!r} is not mapped and has no SQL to derive it")
        chosen.append(F.expr(unique_sql).alias(unique_id))
    return df.select(*chosen)


def drop_null_key_columns(df: DataFrame) -> DataFrame:
    """Drop columns a pivot named after a null key."""
    return df.select(*[column(c) for c in df.columns if not c.startswith("null_")])
