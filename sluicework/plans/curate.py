"""Raw documents to curated tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.operators.assemble import assemble
from sluicework.operators.dedup import latest_per_key
from sluicework.operators.layout import table_metrics
from sluicework.operators.mapping import (
    FieldRule,
    apply_mapping,
    check_targets,
    explode_targets,
    field_rules,
    mapped_fields,
    mapping_sources,
)
from sluicework.operators.merge import merge_insert, merge_newer
from sluicework.operators.nested import Pivot, flatten_documents
from sluicework.operators.schema import (
    apply_filters,
    column,
    key_overrides,
    rename_duplicate_columns,
    select_with_key,
)
from sluicework.sources.control import advance, read_control
from sluicework.sources.files import read_files
from sluicework.sources.scratch import written_out
from sluicework.sources.tables import create_table, merge_table, read_table
from sluicework.sources.versions import read_version, write_version

UPSERT = "upsert"


@dataclass(frozen=True)
class SourceSpec:
    """How the rows of one source are identified and shaped."""

    unique_id: str
    incremental_key: str
    unique_sql: str | None = None
    filters: Sequence[Mapping[str, str]] = ()
    arrays: Mapping[str, str | Pivot] = field(default_factory=dict)
    keep_unique_id: bool = False


@dataclass(frozen=True)
class TargetSpec:
    """One curated table."""

    name: str
    unique_id: str
    id_sql: str
    incremental_key: str
    incremental_sql: str
    partition_column: str
    partition_sql: str
    from_sql: str
    mode: str = UPSERT
    path: str | None = None

    @classmethod
    def from_control(cls, row: Mapping) -> TargetSpec:
        return cls(
            name=row["name"],
            unique_id=row["unique_id"],
            id_sql=row["id_sql"],
            incremental_key=row["incremental_key"],
            incremental_sql=row["incremental_sql"],
            partition_column=row["partition_columns"],
            partition_sql=row["partition_sql"],
            from_sql=row["from_sql"],
            mode=row["mode"],
            path=row.get("path"),
        )


@dataclass(frozen=True)
class CuratedSource:
    """A curated source, the fields it gives its target and those it lacks.

    ``candidates`` are the rows before older ones are dropped; there are none
    exactly if there are no ``rows``, and finding out takes no shuffle.
    """

    rows: DataFrame
    candidates: DataFrame
    fields: list[str]
    missed: list[str]


def curate_source(
    raw: DataFrame,
    rules: Sequence[FieldRule],
    spec: SourceSpec,
    as_of: Column | None = None,
) -> CuratedSource:
    """Repair names, flatten, filter, map and keep the newest distinct rows per key.

    Filters are stated after flattening; Catalyst moves those on unexploded
    columns down to the scan.  Duplicates go after older rows, since they are
    then clustered by key already.
    """
    spec = replace(spec, **key_overrides(spec.filters))
    filtered = _filtered(raw, spec)
    mapped, missed = apply_mapping(filtered, rules, as_of)
    fields = mapped_fields(filtered, rules)
    return _newest(select_with_key(mapped, fields, spec.unique_id, spec.unique_sql), fields, missed, spec)


def _filtered(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    return apply_filters(flatten_documents(rename_duplicate_columns(raw), spec.arrays), spec.filters)


def _newest(selected: DataFrame, fields: list[str], missed: list[str], spec: SourceSpec) -> CuratedSource:
    rows = latest_per_key(selected, spec.unique_id, spec.incremental_key).distinct()
    candidates = selected.where(column(spec.incremental_key).isNotNull())
    if spec.keep_unique_id and spec.unique_id not in fields:
        fields.append(spec.unique_id)
    kept = [
        f
        for f in fields
        if f != spec.incremental_key and (spec.keep_unique_id or f != spec.unique_id)
    ]
    return CuratedSource(rows, candidates, kept, missed)


def curate_targets(
    raw: DataFrame,
    rules: Mapping[str, Sequence[FieldRule]],
    spec: SourceSpec,
    as_of: Column | None = None,
) -> dict[str, CuratedSource]:
    """One source curated for several targets from one scan.

    Raw rows are read, flattened and filtered once; the rules of all targets make one
    projection with a struct per target, written to the scratch folder.  Each target
    then reads its own struct alone and keeps its newest rows.  The same as
    :func:`curate_source` for every target.
    """
    spec = replace(spec, **key_overrides(spec.filters))
    filtered = _filtered(raw, spec)
    kept = "__raw"
    wide = filtered.select(F.struct(*map(column, filtered.columns)).alias(kept))
    found: dict[str, tuple[str, list[str], list[str]]] = {}
    for number, (target, own) in enumerate(rules.items()):
        packed = [name for name, _, _ in found.values()]
        mapped, missed = apply_mapping(wide.select(kept, *packed, f"{kept}.*"), own, as_of)
        fields = mapped_fields(filtered, own)
        chosen = select_with_key(mapped, [*fields, kept, *packed], spec.unique_id, spec.unique_sql)
        values = [c for c in chosen.columns if c != kept and c not in packed]
        found[target] = f"__target_{number}", fields, missed
        wide = chosen.select(kept, *packed, F.struct(*map(column, values)).alias(found[target][0]))
    once = written_out(wide.drop(kept))
    return {
        target: _newest(once.select(f"{name}.*"), fields, missed, spec)
        for target, (name, fields, missed) in found.items()
    }


def source_views(sources: Iterable[tuple[str, str]]) -> dict[tuple[str, str], str]:
    """View names of sources by database and collection.

    A source is called by its collection, and by ``database_collection`` where
    several databases have a collection of that name.  Names that still collide,
    in any case, raise.
    """
    sources = sorted(set(sources))
    shared = Counter(collection.lower() for _, collection in sources)
    views = {
        (database, collection): collection
        if shared[collection.lower()] == 1
        else f"{database}_{collection}"
        for database, collection in sources
    }
    taken = Counter(view.lower() for view in views.values())
    collisions = sorted(view for view in views.values() if taken[view.lower()] > 1)
    if collisions:
        raise ValueError(f"sources share a view name: {collisions}")
    return views


def load_sources(
    spark: SparkSession,
    mapping: DataFrame,
    configs: Mapping[str, DataFrame],
    target: str,
    modified_after: str | None,
    filters: Mapping[str | tuple[str, str], Sequence[Mapping[str, str]]] | None = None,
    arrays: Mapping[str, str | Pivot] | None = None,
    keep_unique_id: bool = False,
    as_of: Column | None = None,
) -> dict[str, CuratedSource]:
    """Scan and curate every source that is mapped to a target.

    ``configs`` holds the control tables by name; all plans stay lazy.  A source
    that maps a target column twice is an error; two sources may share one, and
    so may their collections share a name: the result is keyed by
    :func:`source_views`.  ``filters`` are given by (database, collection), or by
    collection for every database that has it.
    """
    targets = explode_targets(mapping)
    check_targets(targets, target, within_source=True)
    found = sorted(mapping_sources(targets, target).collect())
    views = source_views((database, collection) for database, collection, _ in found)
    if len(views) < len(found):
        raise ValueError(f"a source of {target} is in several control tables")
    filters = filters or {}
    curated = {}
    for database, collection, config in found:
        details = read_control(configs[config], collection, database)
        own = filters.get((database, collection), filters.get(collection, ()))
        raw, spec = _scanned(spark, details, modified_after, own, arrays, keep_unique_id)
        rules = field_rules(targets, target, collection, database)
        curated[views[database, collection]] = curate_source(raw, rules, spec, as_of)
    return curated


def _scanned(
    spark: SparkSession,
    details: Mapping,
    modified_after: str | None,
    filters: Sequence[Mapping[str, str]],
    arrays: Mapping[str, str | Pivot] | None,
    keep_unique_id: bool,
) -> tuple[DataFrame, SourceSpec]:
    raw = read_files(
        spark,
        details["src_path"],
        modified_after,
        details["format"],
        details["source"],
        details.get("schema"),
    )
    spec = SourceSpec(
        unique_id=details["unique_id"],
        incremental_key=details["incremental_key"],
        unique_sql=details.get("unq_sql"),
        filters=filters,
        arrays=arrays or {},
        keep_unique_id=keep_unique_id,
    )
    return raw, spec


def load_targets(
    spark: SparkSession,
    mapping: DataFrame,
    configs: Mapping[str, DataFrame],
    targets: Sequence[str],
    modified_after: str | None,
    filters: Mapping[str | tuple[str, str], Sequence[Mapping[str, str]]] | None = None,
    arrays: Mapping[str, str | Pivot] | None = None,
    keep_unique_id: bool = False,
    as_of: Column | None = None,
) -> dict[str, dict[str, CuratedSource]]:
    """The sources of several targets that are loaded together, each scanned once.

    Returns by target what :func:`load_sources` gives for it.
    """
    exploded = explode_targets(mapping)
    sources: dict[tuple[str, str, str], list[str]] = {}
    views: dict[str, dict[tuple[str, str], str]] = {}
    for target in targets:
        check_targets(exploded, target, within_source=True)
        found = sorted(mapping_sources(exploded, target).collect())
        views[target] = source_views((database, collection) for database, collection, _ in found)
        if len(views[target]) < len(found):
            raise ValueError(f"a source of {target} is in several control tables")
        for source in found:
            sources.setdefault(tuple(source), []).append(target)
    filters = filters or {}
    curated: dict[str, dict[str, CuratedSource]] = {target: {} for target in targets}
    for (database, collection, config), own in sources.items():
        details = read_control(configs[config], collection, database)
        raw, spec = _scanned(
            spark, details, modified_after, filters.get((database, collection), filters.get(collection, ())), arrays, keep_unique_id
        )
        rules = {target: field_rules(exploded, target, collection, database) for target in own}
        for target, source in curate_targets(raw, rules, spec, as_of).items():
            curated[target][views[target][database, collection]] = source
    return curated


def assemble_batch(
    spark: SparkSession, sources: Mapping[str, CuratedSource], spec: TargetSpec
) -> DataFrame:
    """Rows the sources give the target."""
    return assemble(
        spark,
        {name: source.rows for name, source in sources.items()},
        _target_fields(sources, spec),
        spec.unique_id,
        spec.id_sql,
        spec.incremental_key,
        spec.incremental_sql,
        spec.partition_column,
        spec.partition_sql,
        spec.from_sql,
    )


def _target_fields(sources: Mapping[str, CuratedSource], spec: TargetSpec) -> list[str]:
    fields = dict.fromkeys(f for source in sources.values() for f in source.fields)
    return [f for f in fields if f != spec.partition_column]


def merge_batch(
    batch: DataFrame,
    current: DataFrame,
    sources: Mapping[str, CuratedSource],
    spec: TargetSpec,
) -> DataFrame:
    """State of the target after a batch.

    With several sources a row may be partial: an update then keeps stored
    values where the row has none.
    """
    if spec.mode != UPSERT:
        return merge_insert(current, batch, spec.unique_id)
    partial = len(sources) > 1
    return merge_newer(
        current, batch, spec.unique_id, spec.incremental_key, fill_nulls=partial
    )


def load_target(
    spark: SparkSession,
    sources: Mapping[str, CuratedSource],
    spec: TargetSpec,
    version: int | None,
    shuffle: bool = True,
    file_format: str = "parquet",
    in_place: bool = False,
) -> dict[str, int]:
    """Write the next version of a target and return its metrics.

    ``in_place`` writes only the partitions that change and keeps the changed rows, see
    :mod:`sluicework.sources.tables`; else every version is a whole table of its own.

    ``version`` is the current one, None on a first load.  Without rows to load
    nothing is written and there are no metrics.  A batch to merge is written to
    the scratch folder first: the merge reads it several times, and plans its
    joins by the size it really has.  Only a first load shuffles to lay out its
    files; a merge leaves rows with the task that read them.
    """
    if all(source.candidates.isEmpty() for source in sources.values()):
        return {}
    state = assemble_batch(spark, sources, spec)
    if in_place:
        return _load_in_place(spark, state, sources, spec, version, shuffle)
    if version is not None:
        batch = written_out(state)
        if batch.isEmpty():
            return {}
        current = read_version(spark, spec.path, version, file_format)
        state = merge_batch(batch, current, sources, spec)
    first = version is None
    return write_version(
        state,
        spec.path,
        0 if first else version + 1,
        spec.partition_column,
        shuffle and first,
        file_format,
    )


def _load_in_place(
    spark: SparkSession,
    state: DataFrame,
    sources: Mapping[str, CuratedSource],
    spec: TargetSpec,
    version: int | None,
    shuffle: bool,
) -> dict[str, int]:
    load = 0 if version is None else version + 1
    if version is None:
        create_table(state, spec.path, spec.partition_column, shuffle)
    else:
        batch = written_out(state)
        if batch.isEmpty():
            return {}
        is_upsert = spec.mode == UPSERT
        merge_table(
            spark,
            spec.path,
            batch,
            spec.unique_id,
            spec.partition_column,
            load,
            spec.incremental_key if is_upsert else None,
            insert_only=not is_upsert,
            fill_nulls=is_upsert and len(sources) > 1,
        )
    return {**table_metrics(read_table(spark, spec.path)).first().asDict(), "version": load}


def control_update(
    spark: SparkSession, name: str, started_at: str, metrics: Mapping[str, int]
) -> DataFrame:
    """The control row change of a finished load."""
    return spark.range(1).select(
        F.lit(name).alias("name"),
        F.lit(started_at).alias("last_modified"),
        *[F.lit(value).cast("bigint").alias(key) for key, value in metrics.items()],
    )


def run_load(
    spark: SparkSession,
    target: str,
    mapping: DataFrame,
    configs: Mapping[str, DataFrame],
    curated: DataFrame,
    started_at: str,
    shuffle: bool = True,
    file_format: str = "parquet",
    in_place: bool = False,
    **options,
) -> DataFrame:
    """One load of a target from its control row; returns the control rows after it.

    ``options`` are those of :func:`load_sources`.  The caller stores the result,
    which is when readers see the new version.
    """
    details = read_control(curated, target)
    sources = load_sources(
        spark, mapping, configs, target, details["last_modified"], **options
    )
    version = None if details["first_load"] else details["version"]
    spec = TargetSpec.from_control(details)
    metrics = load_target(spark, sources, spec, version, shuffle, file_format, in_place)
    if not metrics:
        return curated
    return advance(curated, control_update(spark, target, started_at, metrics))
