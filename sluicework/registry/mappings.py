"""Source-to-target mapping, with tables of any size standing in for metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.operators import mapping
from sluicework.registry.common import Query, table


def _mapping_rows(spark, sf_dir) -> DataFrame:
    """A mapping row per part: its type and brand are the targets."""
    return table(spark, sf_dir, "part").select(
        F.concat("p_type", F.lit(", "), "p_brand").alias("DEST_TABLE"),
        F.concat(F.lit("db"), F.col("p_size").cast("string")).alias("SRC_DB"),
        F.col("p_type").alias("SRC_COLLECTION"),
        F.lit("raw").alias("SRC_CONFIG"),
        F.concat(F.lit("A.b"), F.col("p_partkey").cast("string")).alias("SRC_FIELD"),
        F.col("p_name").alias("DEST_COLUMN"),
    )


# Names of mapping columns.
MAPPING_ROWS = """
SELECT unnest([p_type, p_brand]) AS DEST_TABLE, concat('db', p_size) AS SRC_DB,
       p_type AS SRC_COLLECTION, 'raw' AS SRC_CONFIG, concat('A.b', p_partkey) AS SRC_FIELD,
       p_name AS DEST_COLUMN
FROM part
"""


def mapping_explode(spark, sf_dir):
    return mapping.explode_targets(_mapping_rows(spark, sf_dir))


def mapping_duplicates(spark, sf_dir):
    rows = mapping.explode_targets(_mapping_rows(spark, sf_dir))
    return mapping.duplicate_targets(rows).withColumnRenamed("count", "n")


MAPPING_DUPLICATES = f"""
SELECT DEST_TABLE, lower(DEST_COLUMN) AS DEST_COLUMN, count(*) AS n FROM ({MAPPING_ROWS})
GROUP BY 1, 2 HAVING count(*) > 1
"""


def mapping_sources(spark, sf_dir):
    return mapping.mapping_sources(mapping.explode_targets(_mapping_rows(spark, sf_dir)), "ECONOMY")


MAPPING_SOURCES = f"""
SELECT DISTINCT SRC_DB, SRC_COLLECTION, SRC_CONFIG FROM ({MAPPING_ROWS}) WHERE DEST_TABLE = 'ECONOMY'
"""

EVENT_RULES = [
    mapping.FieldRule("event_id", "id", datatype="string"),
    mapping.FieldRule("doc_at", "seen_at", "udf_utc_to_ist", datatype="string"),
    mapping.FieldRule("doc_epoch", "epoch_at", "udf_epoch_to_ist", datatype="string"),
    mapping.FieldRule("doc_iso", "iso_at", "udf_str_to_ist", datatype="string"),
    mapping.FieldRule("doc_born", "born", "extract_year", datatype="date"),
    mapping.FieldRule("doc_user", "user_hash", pii=True, datatype="bigint"),
    mapping.FieldRule("doc_user", "user_no", datatype="int"),
    mapping.FieldRule("event_type", "bad_number", datatype="int"),
    mapping.FieldRule("doc_absent", "never", datatype="string"),
]


def apply_mapping(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("Event_ID"),
        "event_type",
        F.col("ts").alias("doc_at"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("doc_epoch"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("doc_iso"),
        F.date_add(F.col("ts").cast("date"), -F.col("user_id").cast("int") * 90).alias("doc_born"),
        F.col("user_id").alias("doc_user"),
        F.col("value").alias("doc_value"),
    )
    mapped, missed = mapping.apply_mapping(events, EVENT_RULES, F.lit("2024-06-20").cast("date"))
    fields = mapping.mapped_fields(events, EVENT_RULES)
    return mapped.select(*fields, "age", F.lit(",".join(missed)).alias("missed"))


APPLY_MAPPING = """
SELECT CAST(event_id AS VARCHAR) AS id, ts + INTERVAL 330 MINUTE AS seen_at,
       date_trunc('second', ts)::TIMESTAMP + INTERVAL 330 MINUTE AS epoch_at,
       date_trunc('millisecond', ts)::TIMESTAMP + INTERVAL 330 MINUTE AS iso_at,
       CAST(year(b) AS VARCHAR) AS born, sha256(CAST(user_id AS VARCHAR)) AS user_hash,
       CAST(user_id AS INTEGER) AS user_no, CAST(NULL AS INTEGER) AS bad_number,
       CAST(2024 - year(b) - CASE WHEN month(b) * 100 + day(b) > 620 THEN 1 ELSE 0 END AS INTEGER) AS age,
       'never' AS missed
FROM (SELECT *, CAST(ts AS DATE) - CAST(user_id AS INTEGER) * 90 AS b FROM events)
"""


def rename_and_cast(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    priced = mapping.rename_and_cast(part, "p_retailprice", "price", "decimal(12,2)")
    return mapping.rename_and_cast(priced, "p_name", "name_number", "bigint")


RENAME_AND_CAST = """
SELECT p_partkey, CAST(NULL AS BIGINT) AS name_number, CAST(p_retailprice AS DECIMAL(12,2)) AS price
FROM part
"""

QUERIES = {
    "mapping_explode": Query(mapping_explode, MAPPING_ROWS),
    "mapping_duplicates": Query(mapping_duplicates, MAPPING_DUPLICATES),
    "mapping_sources": Query(mapping_sources, MAPPING_SOURCES),
    "apply_mapping": Query(apply_mapping, APPLY_MAPPING),
    "rename_and_cast": Query(rename_and_cast, RENAME_AND_CAST),
}
