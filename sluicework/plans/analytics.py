"""Curated tables to analytics tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.operators.assemble import run_sql
from sluicework.operators.layout import table_metrics
from sluicework.operators.merge import CHANGE_TYPE, drop_preimages, merge_always, merge_newer
from sluicework.plans.curate import control_update
from sluicework.sources.control import advance, read_control
from sluicework.sources.scratch import written_out
from sluicework.sources.tables import create_table, has_table, merge_table, read_load_changes, read_table
from sluicework.sources.versions import read_changes, read_version, write_version


def analytics_inputs(
    spark: SparkSession,
    curated: DataFrame,
    sources: str,
    first_load: bool,
    loaded: Mapping[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Each named curated table: whole on a first load, else what changed.

    That is what the loads after the one named in ``loaded`` changed, netted; without one,
    what the last load changed.  A table changed in place gives the changes its loads
    have kept; of one kept by versions, the last two are compared.
    """
    inputs = {}
    for name in (part.strip() for part in sources.split(",")):
        details = read_control(curated, name)
        version = int(details["version"])
        after = (loaded or {}).get(name, version - 1)
        if not has_table(spark, details["path"]):
            inputs[name] = read_changes(spark, details["path"], version, first_load, details["unique_id"])
        elif first_load or version == 0:
            inputs[name] = read_table(spark, details["path"])
        else:
            changed = read_load_changes(spark, details["path"], details["unique_id"], after, version)
            inputs[name] = drop_preimages(changed)
    return inputs


def analytics_rows(
    spark: SparkSession, inputs: dict[str, DataFrame], query: str
) -> DataFrame:
    """User SQL over the inputs."""
    return run_sql(spark, inputs, query)


def load_analytics(
    rows: DataFrame,
    path: str,
    version: int | None,
    unique_id: str,
    partition_column: str,
    incremental_key: str | None = None,
    in_place: bool = False,
) -> dict[str, int]:
    """Merge rows into an analytics table as its next version; returns its metrics.

    Rows replace stored ones of their key, or only older ones if there is an
    incremental key to tell.  ``in_place`` writes only the partitions that change.
    """
    spark = rows.sparkSession
    if in_place:
        load = 0 if version is None else version + 1
        if version is None:
            create_table(rows, path, partition_column)
        else:
            merge_table(spark, path, rows, unique_id, partition_column, load, incremental_key)
        return {**table_metrics(read_table(spark, path)).first().asDict(), "version": load}
    if version is None:
        return write_version(rows, path, 0, partition_column)
    batch = written_out(rows)
    current = read_version(spark, path, version)
    if incremental_key is None:
        state = merge_always(current, batch, unique_id)
    else:
        state = merge_newer(current, batch, unique_id, incremental_key)
    return write_version(state, path, version + 1, partition_column, shuffle=False)


def run_analytics(
    spark: SparkSession, name: str, analytics: DataFrame, curated: DataFrame, query: str, started_at: str
) -> DataFrame:
    """One load of an analytics table from its control row; returns the control rows after it.

    The row names ``sources``, ``path``, ``unique_id``, ``partition_columns``, perhaps an
    ``incremental_key``, and in ``source_versions`` (name to version) what it has seen of
    them.  Sources that moved on by several loads give the netted changes of all of
    them; if none moved on, the control rows stay as they are.
    """
    details = read_control(analytics, name)
    names = [part.strip() for part in details["sources"].split(",")]
    now = {source: int(read_control(curated, source)["version"]) for source in names}
    seen = dict(details.get("source_versions") or {})
    first = details["first_load"]
    if not first and all(seen.get(source) == version for source, version in now.items()):
        return analytics
    inputs = analytics_inputs(spark, curated, details["sources"], first, seen)
    version = None if first else int(details["version"])
    rows = analytics_rows(spark, inputs, query).drop(CHANGE_TYPE)
    metrics = load_analytics(
        rows, details["path"], version, details["unique_id"], details["partition_columns"], details.get("incremental_key"), in_place=True
    )
    versions = F.create_map(*[part for source, version in now.items() for part in (F.lit(source), F.lit(version).cast("bigint"))])
    return advance(analytics, control_update(spark, name, started_at, metrics).withColumn("source_versions", versions))
