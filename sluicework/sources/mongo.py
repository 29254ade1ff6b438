"""MongoDB scan and sink, for sessions with the connector on their classpath."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

MONGO_FORMAT = "mongodb"

# Documents drawn to infer a schema, and the pool they come from.
SAMPLE_SIZE = 100_000
SAMPLE_POOL_SIZE = 1_000_000


def connection_options(
    connection: str, database: str, collection: str, **options: object
) -> dict[str, str]:
    return {
        "connection.uri": connection,
        "database": database,
        "collection": collection,
        **{name: str(value) for name, value in options.items()},
    }


def scan_options(
    connection: str,
    database: str,
    collection: str,
    pipeline: str | Sequence[Mapping] = (),
    infer_schema: bool = True,
    sample_pool_size: int = SAMPLE_POOL_SIZE,
    sample_size: int = SAMPLE_SIZE,
) -> dict[str, str]:
    """Options of a scan whose aggregation pipeline runs inside the server."""
    extra: dict[str, object] = {
        "inferSchema": str(infer_schema).lower(),
        "samplePoolSize": sample_pool_size,
        "sampleSize": sample_size,
    }
    if pipeline:
        text = pipeline if isinstance(pipeline, str) else json.dumps(list(pipeline))
        extra["aggregation.pipeline"] = text
    return connection_options(connection, database, collection, **extra)


def read(
    spark: SparkSession, connection: str, database: str, collection: str, **options: object
) -> DataFrame:
    chosen = connection_options(connection, database, collection, **options)
    return spark.read.format(MONGO_FORMAT).options(**chosen).load()


def read_pipeline(
    spark: SparkSession,
    connection: str,
    database: str,
    collection: str,
    pipeline: str | Sequence[Mapping] = (),
    **sampling: object,
) -> DataFrame:
    chosen = scan_options(connection, database, collection, pipeline, **sampling)
    return spark.read.format(MONGO_FORMAT).options(**chosen).load()


def write(
    df: DataFrame,
    connection: str,
    database: str,
    collection: str,
    mode: str = "append",
    **options: object,
) -> None:
    """Write to a collection; failures raise."""
    chosen = connection_options(connection, database, collection, **options)
    df.write.format(MONGO_FORMAT).mode(mode).options(**chosen).save()
