"""Merges of a batch into a snapshot, and the changes between two snapshots.

All operators return the new state as a DataFrame and leave writing to the
caller.  A merge is one full outer join, which reads and shuffles either side
once.  A batch small enough to broadcast is merged by a left join that updates
target rows and an anti-join that finds the rows to insert: then a large target
is not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from sluicework.operators.evolve import adds_fields, conformed, same_shape, widened_type
from sluicework.operators.schema import column
from sluicework.operators.skew import (
    any_null,
    common_kinds,
    fan_out,
    is_broadcastable,
    is_orderable,
    key_list,
    lookup_join,
    row_salt,
)

CHANGE_TYPE = "_change_type"
INSERT = "insert"
DELETE = "delete"
PREIMAGE = "update_preimage"
POSTIMAGE = "update_postimage"

_ROW = "__row"
_COUNT = "__count"
_UPDATE = "__update"
_NET = "__net"
_MINE = "__mine"
_SALT = "__salt"
_THEIR_SALT = "__their_salt"
_NEWEST = "__newest"
_RANK = "__rank"
_ADDED = "__added"
_CHANGED = "__changed"
_COPIES_PER_SLICE = 10_000

# What a row of a merge with changes is: of the new state, or of what changed.
OUTPUT = "_output"
STATE = "state"
CHANGES = "changes"

# The rows a joined row may give: of the new state, and before and after a change.
_KEPT, _BEFORE, _AFTER = 0, 1, 2


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Non-null keys that several rows share."""
    keys = key_list(keys)
    return (
        df.where(~any_null(keys)).groupBy(*map(column, keys)).count().where("count > 1")
    )


@dataclass(frozen=True)
class _Field:
    """An output column: its name in target and in source, its type there and the wider one of both."""

    name: str
    ours: str | None
    theirs: str | None
    kind: DataType
    source_kind: DataType | None

    def stored(self) -> Column:
        """The value of a target of :func:`_widened`."""
        return column(self.ours) if self.ours else F.lit(None).cast(self.kind)

    def new(self, row: Column, keep_stored: bool) -> Column:
        """The value of a source row; inner fields that sources lack may be the stored ones."""
        stored = column(self.ours) if self.ours and keep_stored else None
        return conformed(row, self.source_kind, self.kind, stored)


def _evolved(target: DataFrame, source: DataFrame, evolve: bool) -> list[_Field]:
    """Output columns; raises if they are not those of the target and ``evolve`` is off."""
    in_source = {f.name.lower(): f for f in source.schema.fields}
    in_target = {f.name.lower() for f in target.schema.fields}
    if not evolve and in_target != in_source.keys():
        raise ValueError(f"columns differ and evolve is off: {sorted(in_target ^ in_source.keys())}")
    fields = []
    for own in target.schema.fields:
        other = in_source.get(own.name.lower())
        if not evolve and adds_fields(own.dataType, other.dataType):
            raise ValueError(f"fields of {own.name} differ and evolve is off")
        kind = widened_type(own.dataType, other.dataType) if other and evolve else own.dataType
        fields.append(_Field(own.name, own.name, other and other.name, kind, other and other.dataType))
    added = [f for f in source.schema.fields if f.name.lower() not in in_target]
    return fields + [_Field(f.name, None, f.name, f.dataType, f.dataType) for f in added]


def _widened(target: DataFrame, fields: list[_Field]) -> DataFrame:
    """The target with its columns in their wider types; the same plan if none is wider."""
    kinds = {f.name: f.dataType for f in target.schema.fields}
    own = [f for f in fields if f.ours]
    if all(same_shape(kinds[f.ours], f.kind) for f in own):
        return target
    return target.select(*[conformed(column(f.ours), kinds[f.ours], f.kind).alias(f.ours) for f in own])


def _new_rows(target: DataFrame, source: DataFrame, keys: list[str], split: int | None) -> DataFrame:
    """Source rows whose key the target lacks, null keys among them."""
    present = target.select(*map(column, keys)).where(~any_null(keys))
    wanted = source.select(*map(column, keys))
    if is_broadcastable(wanted):
        present = present.join(wanted, keys, "left_semi")
    return lookup_join(source, present.distinct(), keys, "left_anti", split)


def _insertable(fields: list[_Field], rows: DataFrame) -> DataFrame:
    return rows.select(
        *[
            (f.new(column(f.theirs), False) if f.theirs else F.lit(None).cast(f.kind)).alias(f.name)
            for f in fields
        ]
    )


def _updated(fields: list[_Field], fill_nulls: bool) -> list[Column]:
    """Output columns of joined rows: those of the source row where it updates."""
    found = []
    for f in fields:
        if f.theirs is None:
            found.append(column(f.ours))
            continue
        new = f.new(F.col(_ROW).getField(f.theirs), True)
        new = F.coalesce(new, f.stored()) if fill_nulls else new
        found.append(F.when(F.col(_UPDATE), new).otherwise(f.stored()).alias(f.name))
    return found


def _merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    one_per_key: Callable[[Column], Column],
    newest: Column,
    is_newer: Callable[[Column], Column],
    unique_source: bool,
    evolve: bool,
    fill_nulls: bool,
    split_above: int | None,
) -> DataFrame:
    fields = _evolved(target, source, evolve)
    target = _widened(target, fields)
    if split_above is None and not is_broadcastable(source):
        joined = _joined_in_one_pass(target, source, keys, newest, is_newer, unique_source)
        return joined.select(*_updated(fields, fill_nulls))
    packed = source.where(~any_null(keys)).select(
        *map(column, keys), F.struct(*map(column, source.columns)).alias(_ROW)
    )
    if unique_source:
        packed = packed.withColumn(_COUNT, F.lit(1))
    else:
        packed = packed.groupBy(*map(column, keys)).agg(
            one_per_key(F.col(_ROW)).alias(_ROW), F.count(F.lit(1)).alias(_COUNT)
        )
    joined = lookup_join(target, packed, keys, "left", split_above).withColumn(
        _UPDATE, _updates(keys, is_newer)
    )
    inserts = _insertable(fields, _new_rows(target, source, keys, split_above))
    return joined.select(*_updated(fields, fill_nulls)).unionByName(inserts)


def _updates(keys: list[str], is_newer: Callable[[Column], Column]) -> Column:
    """Whether the joined source row updates the target row; raises if several would."""
    newer = F.coalesce(is_newer(F.col(_ROW)), F.lit(False)) & F.col(_ROW).isNotNull()
    ambiguous = F.raise_error(F.lit(f"several source rows update one row by key {keys}"))
    return F.when(newer & (F.col(_COUNT) > 1), ambiguous.cast("boolean")).otherwise(newer)


def _joined_in_one_pass(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    newest: Column,
    is_newer: Callable[[Column], Column],
    unique_source: bool,
) -> DataFrame:
    """A full outer join with markers.  Null keys match nothing in it, so they are
    spread by a salt; source rows of a key meet a target row by the newest alone."""
    tasks = fan_out(target.sparkSession)

    def salted(df: DataFrame) -> Column:
        return F.when(any_null(keys), row_salt(df, tasks)).otherwise(F.lit(0))

    theirs = [f"__key_{i}" for i in range(len(keys))]
    shared = common_kinds(target, source, keys)
    packed = source.select(
        *[column(k).cast(kind).alias(t) for k, t, kind in zip(keys, theirs, shared)],
        salted(source).alias(_THEIR_SALT),
        newest.alias(_NEWEST),
        F.struct(*map(column, source.columns)).alias(_ROW),
    )
    if unique_source:
        packed = packed.withColumn(_COUNT, F.lit(1)).withColumn(_RANK, F.lit(1))
    else:
        by_key = Window.partitionBy(*theirs, _THEIR_SALT)
        packed = packed.withColumn(_RANK, F.row_number().over(by_key.orderBy(F.desc_nulls_last(_NEWEST))))
        packed = packed.withColumn(_COUNT, F.count(F.lit(1)).over(by_key))
    ours = target.withColumn(_SALT, salted(target)).withColumn(_MINE, F.lit(True))
    same = [ours[k].cast(kind) == packed[t] for k, t, kind in zip(keys, theirs, shared)]
    return (
        ours.join(packed, [*same, ours[_SALT] == packed[_THEIR_SALT]], "full")
        .where(F.col(_MINE).isNull() | F.col(_ROW).isNull() | (F.col(_RANK) == 1))
        .withColumn(_UPDATE, F.col(_MINE).isNull() | _updates(keys, is_newer))
    )


def merge_newer(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    incremental_key: str,
    unique_source: bool = False,
    evolve: bool = True,
    fill_nulls: bool = False,
    split_above: int | None = None,
) -> DataFrame:
    """Update matched rows whose source is newer, insert unmatched source rows.

    A null incremental key on either side updates nothing.  Null keys match
    nothing.  With ``evolve``, new source columns and inner fields are added, types
    are widened, and what the source lacks keeps its value, null for inserted rows;
    see :mod:`sluicework.operators.evolve`.  Several source rows
    for one updated row raise; ``unique_source`` promises there are none and
    saves what it takes to find out.  ``split_above`` is for targets with many rows
    of one key: above that size they are joined in two passes, heavy keys split.

    With ``fill_nulls``, an update keeps the stored value where the source has
    null: the same as back-filling the source first, but the stored table is
    read and joined once less.
    """
    return _merge(
        target,
        source,
        key_list(keys),
        lambda row: F.max_by(row, row.getField(incremental_key)),
        column(incremental_key),
        lambda row: row.getField(incremental_key) > column(incremental_key),
        unique_source,
        evolve,
        fill_nulls,
        split_above,
    )


def merge_always(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    unique_source: bool = False,
    evolve: bool = True,
    split_above: int | None = None,
) -> DataFrame:
    """Replace matched rows, insert unmatched source rows."""
    return _merge(
        target,
        source,
        key_list(keys),
        F.any_value,
        F.lit(0),
        lambda row: F.lit(True),
        unique_source,
        evolve,
        False,
        split_above,
    )


def merge_insert(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    evolve: bool = True,
    split_above: int | None = None,
) -> DataFrame:
    """Insert unmatched source rows, leave matched rows alone."""
    fields = _evolved(target, source, evolve)
    target = _widened(target, fields)
    kept = target.select(*[f.stored().alias(f.name) for f in fields])
    new = _new_rows(target, source, key_list(keys), split_above)
    return kept.unionByName(_insertable(fields, new))


def merge_with_changes(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    incremental_key: str | None = None,
    insert_only: bool = False,
    unique_source: bool = False,
    fill_nulls: bool = False,
) -> DataFrame:
    """State after a merge and the rows it changed, from one pass over either side.

    Rows carry ``_output``: ``state`` rows are those of :func:`merge_newer`, of
    :func:`merge_always` without an incremental key, or of :func:`merge_insert`;
    ``changes`` rows have a ``_change_type`` and equal the :func:`change_feed` of the two
    states.  An update that leaves a row as it was is no change.  A small source is
    broadcast and its inserts are found by a second look at the keys alone.
    """
    keys = key_list(keys)
    fields = _evolved(target, source, True)
    target = _widened(target, fields)
    if insert_only:
        newest, is_newer = F.lit(0), lambda row: F.lit(False)
    elif incremental_key is None:
        newest, is_newer = F.lit(0), lambda row: F.lit(True)
    else:
        newest = column(incremental_key)
        is_newer = lambda row: row.getField(incremental_key) > column(incremental_key)
    staged_as = [(f"__before_{i}", f"__after_{i}") for i in range(len(fields))]
    if is_broadcastable(source) and not insert_only:
        packed = source.where(~any_null(keys)).select(
            *map(column, keys), F.struct(*map(column, source.columns)).alias(_ROW)
        )
        packed = packed.groupBy(*map(column, keys)).agg(
            (F.max_by(_ROW, F.col(_ROW).getField(incremental_key)) if incremental_key else F.any_value(_ROW)).alias(_ROW),
            F.count(F.lit(1)).alias(_COUNT),
        )
        joined = lookup_join(target, packed, keys, "left").withColumn(_UPDATE, _updates(keys, is_newer))
        added = _insertable(fields, _new_rows(target, source, keys, None)).select(
            *[F.lit(None).cast(f.kind).alias(b) for f, (b, _) in zip(fields, staged_as)],
            *[column(f.name).alias(a) for f, (_, a) in zip(fields, staged_as)],
            F.lit(True).alias(_ADDED),
            F.lit(True).alias(_UPDATE),
        )
        is_new = F.lit(False)
    else:
        joined = _joined_in_one_pass(target, source, keys, newest, is_newer, unique_source)
        added, is_new = None, F.col(_MINE).isNull()
    staged = joined.select(
        *[f.stored().alias(b) for f, (b, _) in zip(fields, staged_as)],
        *[value.alias(a) for value, (_, a) in zip(_updated(fields, fill_nulls), staged_as)],
        is_new.alias(_ADDED),
        _UPDATE,
    )
    staged = staged.unionAll(added) if added is not None else staged
    differs = F.lit(False)
    for f, (b, a) in zip(fields, staged_as):
        differs = differs | ~_equal(F.col(b), F.col(a), f.kind)
    # A fixed array: of one made row by row, Spark computes the whole expression once more to drop empty ones.
    out = staged.withColumn(_CHANGED, F.col(_ADDED) | (F.col(_UPDATE) & differs)).withColumn(
        _ROW, F.explode(F.array(F.lit(_KEPT), F.lit(_BEFORE), F.lit(_AFTER)))
    )
    is_kept, is_before = F.col(_ROW) == _KEPT, F.col(_ROW) == _BEFORE
    out = out.where(is_kept | (F.col(_CHANGED) & (~is_before | ~F.col(_ADDED))))
    change = F.when(is_before, PREIMAGE).when(~is_kept, F.when(F.col(_ADDED), INSERT).otherwise(POSTIMAGE))
    return out.select(
        *[F.when(is_before, F.col(b)).otherwise(F.col(a)).alias(f.name) for f, (b, a) in zip(fields, staged_as)],
        change.alias(CHANGE_TYPE),
        F.when(is_kept, STATE).otherwise(CHANGES).alias(OUTPUT),
    )


def _equal(x: Column, y: Column, kind: DataType) -> Column:
    """Whether values agree; maps, which do not compare, by their entries in order."""
    if not is_orderable(kind):
        x, y = F.to_json(F.struct(x)), F.to_json(F.struct(y))
    return x.eqNullSafe(y)


def change_feed(
    before: DataFrame,
    after: DataFrame,
    keys: str | Sequence[str],
    split_above: int | None = None,
) -> DataFrame:
    """Rows that differ between two snapshots, with ``_change_type``.

    Rows are netted by their whole content, which drops everything unchanged by
    partial aggregation and never pairs rows of a key.  What is left counts as an
    update where a key occurs on both sides, else as insert or delete.  Columns and
    inner fields that are new in ``after`` were null before, by name.  With ``split_above``, changed rows
    of heavy keys are split above that size, at the price of netting them twice.
    """
    keys = key_list(keys)
    names = after.columns
    known = {f.name.lower(): f for f in before.schema.fields}
    earlier = []
    for f in after.schema.fields:
        old = known.get(f.name.lower())
        value = conformed(column(old.name), old.dataType, f.dataType) if old else F.lit(None).cast(f.dataType)
        earlier.append(value.alias(f.name))
    signed = before.select(*earlier, F.lit(-1).alias(_NET)).unionAll(
        after.select(*map(column, names), F.lit(1).alias(_NET))
    )
    return _netted(signed, keys, names, split_above)


def net_changes(changes: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Changes of several loads in a row as the changes between their ends.

    ``changes`` holds the rows of all these loads with ``_change_type``.  What one load
    made and a later one took away is the same row twice and is netted: updates of a
    key leave its first pre-image and its last post-image, an insert and a delete leave
    nothing.  No order of loads and no pairing of rows is needed, so keys that several
    rows share and null keys come out right as well.
    """
    keys = key_list(keys)
    names = [c for c in changes.columns if c != CHANGE_TYPE]
    is_gone = F.col(CHANGE_TYPE).isin(PREIMAGE, DELETE)
    signed = changes.select(*map(column, names), F.when(is_gone, -1).otherwise(1).alias(_NET))
    return _netted(signed, keys, names, None)


def _netted(signed: DataFrame, keys: list[str], names: list[str], split_above: int | None) -> DataFrame:
    changed = (
        signed.groupBy(*map(column, names)).agg(F.sum(_NET).alias(_NET)).where(f"{_NET} != 0")
    )
    if split_above is None:
        # Changed rows are netted once; null keys are no update and are spread.
        salt = F.when(any_null(keys), row_salt(changed, fan_out(changed.sparkSession))).otherwise(F.lit(0))
        by_key = Window.partitionBy(*map(column, keys), _SALT)
        on_both = (F.min(_NET).over(by_key) < 0) & (F.max(_NET).over(by_key) > 0)
        typed = changed.withColumn(_SALT, salt).withColumn(_UPDATE, ~any_null(keys) & on_both)
    else:
        updated = (
            changed.where(~any_null(keys))
            .groupBy(*map(column, keys))
            .agg(F.min(_NET).alias("__least"), F.max(_NET).alias("__most"))
            .where("__least < 0 AND __most > 0")
            .select(*map(column, keys), F.lit(True).alias(_UPDATE))
        )
        typed = lookup_join(changed, updated, keys, "left", split_above)
    kind = (
        F.when(F.col(_UPDATE) & (F.col(_NET) < 0), PREIMAGE)
        .when(F.col(_UPDATE), POSTIMAGE)
        .when(F.col(_NET) < 0, DELETE)
        .otherwise(INSERT)
    )
    return _repeat_copies(typed.withColumn(CHANGE_TYPE, kind)).select(*map(column, names), CHANGE_TYPE)


def _repeat_copies(df: DataFrame) -> DataFrame:
    """One row per copy, in slices so that no array grows with the copies."""
    copies = F.abs(F.col(_NET))
    slices = F.sequence(F.lit(0).cast("bigint"), copies - 1, F.lit(_COPIES_PER_SLICE).cast("bigint"))
    in_slice = F.least(copies - F.col("__from"), F.lit(_COPIES_PER_SLICE)).cast("int")
    return df.withColumn("__from", F.explode(slices)).withColumn(
        "__copy", F.explode(F.array_repeat(F.lit(True), in_slice))
    )


def drop_preimages(changes: DataFrame) -> DataFrame:
    return changes.where(F.col(CHANGE_TYPE) != PREIMAGE)
