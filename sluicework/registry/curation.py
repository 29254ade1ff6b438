"""The whole way from raw documents to a curated table, loaded twice."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.operators.dedup import latest_per_key
from sluicework.operators.mapping import FieldRule
from sluicework.operators.merge import merge_newer
from sluicework.plans.curate import SourceSpec, curate_source, load_targets, run_load
from sluicework.plans.ingest import ingest, raw_path
from sluicework.registry.common import Query, table
from sluicework.sources.control import NEVER_LOADED, read_control
from sluicework.sources.scratch import scratch_dir
from sluicework.sources.tables import read_table

ORDER_RULES = [
    FieldRule("id", "order_id", datatype="bigint"),
    FieldRule("header_customer", "customer_hash", pii=True, datatype="bigint"),
    FieldRule("header_placed", "placed_at", "udf_str_to_ist", datatype="string"),
    FieldRule("status", "status", datatype="string"),
    FieldRule("price", "price", datatype="double"),
]


def _order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested order documents; each comes twice, its older copy without a price."""
    placed = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    older = F.date_format(
        F.col("o_orderdate") - F.expr("INTERVAL '1' DAY"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    )
    copies = F.explode(
        F.array(
            F.struct(placed.alias("placed"), F.col("o_totalprice").alias("price")),
            F.struct(older.alias("placed"), F.lit(None).cast("double").alias("price")),
        )
    )
    return (
        table(spark, sf_dir, "orders")
        .withColumn("copy", copies)
        .select(
            F.col("o_orderkey").alias("ID"),
            F.struct(
                F.col("o_custkey").alias("Customer"), F.col("copy.placed").alias("Placed")
            ).alias("Header"),
            F.col("o_orderstatus").alias("Status"),
            F.col("copy.price").alias("Price"),
            F.array("o_orderpriority", "o_orderstatus").alias("Notes"),
        )
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested orders, mapped, newest first, merged into an older snapshot, per status."""
    spec = SourceSpec("order_id", "placed_at", filters=[{"column": "id", "value": "null"}])
    source = curate_source(_order_documents(spark, sf_dir), ORDER_RULES, spec)
    snapshot = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("INTERVAL '1' DAY"))
        .otherwise(F.col("o_orderdate"))
        .alias("placed_at"),
        F.lit("old").alias("status"),
        F.lit(0.0).alias("price"),
    )
    merged = merge_newer(snapshot, source.rows, "order_id", "placed_at")
    return merged.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("customer_hash").alias("with_customer"),
        F.max("placed_at").alias("last_at"),
        F.max("price").alias("top_price"),
    )


FLAGSHIP = """
SELECT CASE WHEN o_orderstatus = 'P' THEN 'old' ELSE o_orderstatus END AS status, count(*) AS n,
       count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS with_customer,
       max(CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 1 DAY
                ELSE o_orderdate + INTERVAL 330 MINUTE END) AS last_at,
       max(CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END) AS top_price
FROM orders GROUP BY 1
"""

# Names of mapping and control columns, and the flags of transformations.
MAPPING = """
SELECT * FROM VALUES
  ('sales,audit', 'shop', 'orders', 'raw', 'id', 'order_no', NULL, 'N', 'bigint'),
  ('sales', 'shop', 'orders', 'raw', 'header.customer', 'customer_no', NULL, 'N', 'bigint'),
  ('sales', 'shop', 'orders', 'raw', 'header.placed', 'ordered_at', 'udf_str_to_ist', 'N', 'string'),
  ('sales', 'shop', 'orders', 'raw', 'status', 'status', NULL, 'N', 'string'),
  ('sales', 'shop', 'orders', 'raw', 'price', 'price', NULL, 'N', 'double'),
  ('sales', 'shop', 'orders', 'raw', 'notes', 'notes', NULL, 'N', 'string'),
  ('sales', 'crm', 'people', 'raw', 'key', 'person_no', NULL, 'N', 'bigint'),
  ('sales', 'crm', 'people', 'raw', 'name', 'person_hash', NULL, 'Y', 'string'),
  ('sales', 'crm', 'people', 'raw', 'changed', 'person_at', 'udf_epoch_to_ist', 'N', 'string')
AS t(DEST_TABLE, SRC_DB, SRC_COLLECTION, SRC_CONFIG, SRC_FIELD, DEST_COLUMN, Transformation, PII, SRC_FIELD_DATATYPE)
"""

RAW_CONTROL = """
SELECT * FROM VALUES
  ('orders', 'shop', :orders_at, 'json', 'mongo', 'order_no', 'ordered_at',
   '_airbyte_data STRUCT<ID: BIGINT, Header: STRUCT<Customer: BIGINT, Placed: STRING>, Status: STRING, Price: DOUBLE, Notes: ARRAY<STRING>>'),
  ('people', 'crm', :people_at, 'json', 'kafka', 'person_no', 'person_at',
   'key BIGINT, name STRING, changed BIGINT')
AS t(name, database, src_path, format, source, unique_id, incremental_key, schema)
"""

# Any time before the files of a second load are written.
LAST_RUN = "2020-01-01T00:00:00"

CURATED_CONTROL = """
SELECT 'sales' AS name, :path AS path, :never AS last_modified, 'sale_id' AS unique_id,
       'order_no' AS id_sql, 'changed_at' AS incremental_key,
       'greatest(ordered_at, person_at)' AS incremental_sql, 'state' AS partition_columns,
       'lower(status)' AS partition_sql, 'upsert' AS mode,
       'orders LEFT JOIN people ON customer_no = person_no' AS from_sql,
       CAST(NULL AS BIGINT) AS row_count, CAST(NULL AS BIGINT) AS num_files,
       CAST(NULL AS BIGINT) AS size_in_bytes, CAST(NULL AS BIGINT) AS version,
       CAST(NULL AS STRING) AS created_at
"""


def curate_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources ingested as raw JSON and curated; then orders change and load again.

    The second load sees only changed order files, so its rows are partial and
    keep the stored person.
    """
    root = scratch_dir(spark)
    mapping = spark.sql(MAPPING)
    documents = _order_documents(spark, sf_dir)
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") + 700_000_000).alias("changed"),
    )

    def load(step: int, orders: DataFrame, people: DataFrame) -> None:
        hour = datetime(2024, 6, 20, step)
        orders_at = raw_path(f"{root}/{step}", "mongo", "shop", "orders")
        people_at = raw_path(f"{root}/{step}", "kafka", "crm", "people")
        ingest(orders.select(F.struct(*orders.columns).alias("_airbyte_data")), orders_at, hour)
        ingest(people, people_at, hour)
        raw = spark.sql(RAW_CONTROL, {"orders_at": orders_at, "people_at": people_at})
        control = spark.read.parquet(f"{root}/control/{step - 1}")
        advanced = run_load(
            spark, "sales", mapping, {"raw": raw}, control, hour.isoformat(), in_place=True, keep_unique_id=True
        )
        # Files of a later step are newer than any time before this run.
        watermark = F.lit(LAST_RUN).alias("last_modified")
        kept = [c for c in advanced.columns if c != "last_modified"]
        advanced.select(*kept, watermark).coalesce(1).write.parquet(f"{root}/control/{step}")

    target = {"never": NEVER_LOADED, "path": f"{root}/curated/sales"}
    spark.sql(CURATED_CONTROL, target).coalesce(1).write.parquet(f"{root}/control/0")
    load(1, documents, people)
    later = F.replace(F.col("Header.Placed"), F.lit("T00"), F.lit("T05"))
    changed = (
        documents.where("Status != 'F'")
        .withColumn("Header", F.col("Header").withField("Placed", later))
        .withColumn("Status", F.when(F.col("Status") == "O", F.lit("Closed")))
    )
    load(2, changed, people.where("false"))
    loaded = read_control(spark.read.parquet(f"{root}/control/2"), "sales")
    return read_table(spark, loaded["path"])


CURATE_TWICE = """
SELECT o_orderkey AS sale_id, o_orderkey AS order_no, o_custkey AS customer_no,
       (CASE WHEN o_orderstatus = 'F' THEN o_orderdate ELSE o_orderdate + INTERVAL 5 HOUR END)
         + INTERVAL 330 MINUTE AS changed_at,
       CASE o_orderstatus WHEN 'O' THEN 'Closed' ELSE o_orderstatus END AS status,
       CASE o_orderstatus WHEN 'O' THEN 'closed' ELSE lower(o_orderstatus) END AS state,
       o_totalprice AS price, concat(o_orderpriority, ', ', o_orderstatus) AS notes,
       c_custkey AS person_no, sha256(c_name) AS person_hash
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
"""


SAME_MAPPING = """
SELECT * FROM VALUES
  ('parties', 'buy', 'people', 'raw', 'key', 'party_no', NULL, 'N', 'bigint'),
  ('parties', 'buy', 'people', 'raw', 'name', 'name', NULL, 'N', 'string'),
  ('parties', 'buy', 'people', 'raw', 'changed', 'changed_at', 'udf_epoch_to_ist', 'N', 'string'),
  ('parties', 'sell', 'people', 'raw', 'key', 'party_no', NULL, 'N', 'bigint'),
  ('parties', 'sell', 'people', 'raw', 'name', 'name', NULL, 'N', 'string'),
  ('parties', 'sell', 'people', 'raw', 'nation', 'nation', NULL, 'N', 'int'),
  ('parties', 'sell', 'people', 'raw', 'changed', 'changed_at', 'udf_epoch_to_ist', 'N', 'string')
AS t(DEST_TABLE, SRC_DB, SRC_COLLECTION, SRC_CONFIG, SRC_FIELD, DEST_COLUMN, Transformation, PII, SRC_FIELD_DATATYPE)
"""

SAME_CONTROL = """
SELECT * FROM VALUES
  ('people', 'buy', :buy_at, 'json', 'kafka', 'party_no', 'changed_at', 'key BIGINT, name STRING, changed BIGINT'),
  ('people', 'sell', :sell_at, 'json', 'kafka', 'party_no', 'changed_at', 'key BIGINT, name STRING, nation INT, changed BIGINT')
AS t(name, database, src_path, format, source, unique_id, incremental_key, schema)
"""

SAME_CURATED = """
SELECT 'parties' AS name, :path AS path, :never AS last_modified, 'party_id' AS unique_id,
       'concat(side, party_no)' AS id_sql, 'last_at' AS incremental_key,
       'changed_at' AS incremental_sql, 'kind' AS partition_columns,
       'side' AS partition_sql, 'upsert' AS mode,
       '(SELECT ''buy'' AS side, party_no, name, CAST(NULL AS INT) AS nation, changed_at FROM buy_people
         UNION ALL SELECT ''sell'', party_no, name, nation, changed_at FROM sell_people)' AS from_sql,
       CAST(NULL AS BIGINT) AS row_count, CAST(NULL AS BIGINT) AS num_files,
       CAST(NULL AS BIGINT) AS size_in_bytes, CAST(NULL AS BIGINT) AS version,
       CAST(NULL AS STRING) AS created_at
"""


def curate_same_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two databases with a collection of one name, loaded twice; the second load of
    one has no names, and keeps the stored ones."""
    root = scratch_dir(spark)
    mapping = spark.sql(SAME_MAPPING)
    changed = lambda key, later: (F.col(key) + 700_000_000 + later).alias("changed")
    buyers = lambda later, name: table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), name.alias("name"), changed("c_custkey", later)
    )
    sellers = lambda later: table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), changed("s_suppkey", later)
    )
    target = {"never": NEVER_LOADED, "path": f"{root}/curated/parties"}
    control = spark.sql(SAME_CURATED, target)
    nobody = F.lit(None).cast("string")
    for step, buy, sell in ((1, buyers(0, F.col("c_name")), sellers(0)), (2, buyers(60, nobody), sellers(60).where("false"))):
        hour = datetime(2024, 6, 20, step)
        at = {"buy_at": raw_path(f"{root}/{step}", "kafka", "buy", "people"), "sell_at": raw_path(f"{root}/{step}", "kafka", "sell", "people")}
        ingest(buy, at["buy_at"], hour)
        ingest(sell, at["sell_at"], hour)
        raw = spark.sql(SAME_CONTROL, at)
        control = run_load(spark, "parties", mapping, {"raw": raw}, control, LAST_RUN, in_place=True, keep_unique_id=True)
        kept = f"{root}/control/{step}"
        control.coalesce(1).write.parquet(kept)
        control = spark.read.parquet(kept)
    loaded = read_control(control, "parties")
    return read_table(spark, loaded["path"])


CURATE_SAME_COLLECTION = """
SELECT concat(side, key) AS party_id, key AS party_no, name, nation, kind,
       to_timestamp(key + 700000000 + later)::TIMESTAMP + INTERVAL 330 MINUTE AS last_at
FROM (SELECT 'buy' AS side, 'buy' AS kind, c_custkey AS key, c_name AS name, CAST(NULL AS INT) AS nation, 60 AS later FROM customer
      UNION ALL SELECT 'sell', 'sell', s_suppkey, s_name, s_nationkey, 0 FROM supplier)
"""


def newest_of_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source curated: copies reduced to the newest, structs and arrays mapped."""
    spec = SourceSpec("order_ref", "placed_at", unique_sql="concat('o', order_id)")
    source = curate_source(_order_documents(spark, sf_dir), ORDER_RULES, spec)
    return latest_per_key(source.rows, "order_ref", "placed_at")


NEWEST_OF_COPIES = """
SELECT o_orderkey AS order_id, sha256(CAST(o_custkey AS VARCHAR)) AS customer_hash,
       o_orderdate + INTERVAL 330 MINUTE AS placed_at, o_orderstatus AS status, o_totalprice AS price,
       concat('o', o_orderkey) AS order_ref
FROM orders
"""

TWO_TARGETS = """
SELECT * FROM VALUES
  ('sales', 'shop', 'orders', 'raw', 'id', 'order_no', NULL, 'N', 'bigint'),
  ('sales', 'shop', 'orders', 'raw', 'header.placed', 'ordered_at', 'udf_str_to_ist', 'N', 'string'),
  ('sales', 'shop', 'orders', 'raw', 'status', 'status', NULL, 'N', 'string'),
  ('sales', 'shop', 'orders', 'raw', 'price', 'price', NULL, 'N', 'double'),
  ('audit,sales', 'shop', 'orders', 'raw', 'header.customer', 'customer', NULL, 'N', 'bigint'),
  ('audit', 'shop', 'orders', 'raw', 'id', 'order_no', NULL, 'N', 'bigint'),
  ('audit', 'shop', 'orders', 'raw', 'header.placed', 'ordered_at', 'udf_str_to_ist', 'N', 'string'),
  ('audit', 'shop', 'orders', 'raw', 'status', 'customer_state', NULL, 'N', 'string')
AS t(DEST_TABLE, SRC_DB, SRC_COLLECTION, SRC_CONFIG, SRC_FIELD, DEST_COLUMN, Transformation, PII, SRC_FIELD_DATATYPE)
"""


def curate_two_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders curated for two targets from one scan; the targets side by side."""
    root = scratch_dir(spark)
    orders_at = raw_path(root, "mongo", "shop", "orders")
    documents = _order_documents(spark, sf_dir)
    ingest(documents.select(F.struct(*documents.columns).alias("_airbyte_data")), orders_at, datetime(2024, 6, 20))
    raw = spark.sql(RAW_CONTROL, {"orders_at": orders_at, "people_at": root}).where("name = 'orders'")
    found = load_targets(spark, spark.sql(TWO_TARGETS), {"raw": raw}, ["sales", "audit"], None)
    audit = found["audit"]["orders"].rows.withColumnsRenamed({"customer": "audited", "ordered_at": "audited_at"})
    return found["sales"]["orders"].rows.join(audit, "order_no")


CURATE_TWO_TARGETS = """
SELECT o_orderkey AS order_no, o_orderdate + INTERVAL 330 MINUTE AS ordered_at, o_orderstatus AS status, o_totalprice AS price,
  o_custkey AS customer, o_custkey AS audited, o_orderdate + INTERVAL 330 MINUTE AS audited_at, o_orderstatus AS customer_state
FROM orders
"""

QUERIES = {
    "flagship": Query(flagship, FLAGSHIP),
    "curate_twice": Query(curate_twice, CURATE_TWICE),
    "curate_two_targets": Query(curate_two_targets, CURATE_TWO_TARGETS),
    "curate_same_collection": Query(curate_same_collection, CURATE_SAME_COLLECTION),
    "curate_source": Query(newest_of_copies, NEWEST_OF_COPIES),
}
