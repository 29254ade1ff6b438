"""All queries over the test tables, by name."""

from sluicework.registry import curation, learning, mappings, merges, scalars, shapes, storage
from sluicework.registry.common import Query

MODULES = (scalars, shapes, mappings, merges, storage, learning, curation)


def all_queries() -> dict[str, Query]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}
