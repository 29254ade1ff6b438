"""Operators from DataFrame to DataFrame, usable with ``df.transform``."""

from sluicework.operators.assemble import assemble, backfill, run_sql
from sluicework.operators.dedup import latest_per_key
from sluicework.operators.layout import compact, cut_lineage, table_metrics
from sluicework.operators.mapping import (
    FieldRule,
    apply_mapping,
    check_targets,
    duplicate_targets,
    explode_targets,
    field_rules,
    mapping_sources,
    rename_and_cast,
)
from sluicework.operators.merge import (
    change_feed,
    drop_preimages,
    duplicate_keys,
    merge_always,
    merge_insert,
    merge_newer,
)
from sluicework.operators.nested import Pivot, explode_column, flatten, flatten_documents, pivot
from sluicework.operators.schema import (
    apply_filters,
    filter_column,
    remove_duplicate_columns,
    rename_duplicate_columns,
    select_with_key,
)

# The name users of the transform layer know.
column_map = apply_mapping

__all__ = [
    "FieldRule",
    "Pivot",
    "apply_filters",
    "apply_mapping",
    "assemble",
    "backfill",
    "change_feed",
    "check_targets",
    "column_map",
    "compact",
    "cut_lineage",
    "drop_preimages",
    "duplicate_keys",
    "duplicate_targets",
    "explode_column",
    "explode_targets",
    "field_rules",
    "filter_column",
    "flatten",
    "flatten_documents",
    "latest_per_key",
    "mapping_sources",
    "merge_always",
    "merge_insert",
    "merge_newer",
    "pivot",
    "remove_duplicate_columns",
    "rename_and_cast",
    "rename_duplicate_columns",
    "run_sql",
    "select_with_key",
    "table_metrics",
]
