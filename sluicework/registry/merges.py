"""Newest rows, assembly, merges and change feeds over whole tables.

The batch that meets the stored orders is all of them, altered: keys of finished
orders are new, unassigned ones have none, and dates moved or got lost.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sluicework.operators.assemble import assemble, backfill
from sluicework.operators.dedup import latest_per_key
from sluicework.operators.merge import (
    change_feed,
    duplicate_keys,
    merge_always,
    merge_insert,
    merge_newer,
    merge_with_changes,
)
from sluicework.registry.common import Query, table


def latest_rows(spark, sf_dir):
    """All events of the last day a user was seen, ties kept."""
    events = table(spark, sf_dir, "events").withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    return latest_per_key(events, "user_id", "day").distinct()


LATEST_ROWS = """
SELECT DISTINCT * EXCLUDE (newest) FROM (
  SELECT *, max(day) OVER (PARTITION BY user_id) AS newest
  FROM (SELECT *, date_trunc('day', ts)::TIMESTAMP AS day FROM events))
WHERE day = newest
"""


def latest_null_keys(spark, sf_dir):
    """Null keys are one group, null incremental keys go."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_suppkey")).alias("supplier"),
        F.when(F.col("l_tax") > 0, F.col("l_shipdate")).alias("shipped"),
        "l_orderkey",
        "l_quantity",
    )
    return latest_per_key(lines, "supplier", "shipped").distinct()


LATEST_NULL_KEYS = """
SELECT DISTINCT supplier, shipped, l_orderkey, l_quantity FROM (
  SELECT *, max(shipped) OVER (PARTITION BY supplier) AS newest FROM (
    SELECT CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS supplier,
           CASE WHEN l_tax > 0 THEN l_shipdate END AS shipped, l_orderkey, l_quantity FROM lineitem))
WHERE shipped = newest
"""


def latest_single_row(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return latest_per_key(orders, "o_custkey", "o_orderdate", ties="one")


LATEST_SINGLE_ROW = """
SELECT o_custkey, o_orderdate, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders)
WHERE rn = 1
"""


def curated_assembly(spark, sf_dir):
    frames = {
        "cust": table(spark, sf_dir, "customer"),
        "ord": table(spark, sf_dir, "orders"),
    }
    return assemble(
        spark,
        frames,
        ["c_name", "o_totalprice", "o_orderstatus"],
        unique_id="uid",
        id_sql="concat(o_orderkey, '/', c_custkey)",
        incremental_key="changed_at",
        incremental_sql="greatest(o_orderdate, TIMESTAMP_NTZ '1996-01-01 00:00:00')",
        partition_column="o_orderstatus",
        partition_sql="lower(o_orderstatus)",
        from_sql="ord JOIN cust ON o_custkey = c_custkey",
    )


CURATED_ASSEMBLY = """
SELECT DISTINCT concat(o_orderkey, '/', c_custkey) AS uid, c_name, o_totalprice,
       greatest(o_orderdate, TIMESTAMP '1996-01-01 00:00:00') AS changed_at, lower(o_orderstatus) AS o_orderstatus
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def backfill_partial(spark, sf_dir):
    full = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.lit(1).alias("seen"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"),
    )
    delta = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("id"),
        F.lit(2).alias("seen"),
        F.when(F.col("o_totalprice") > 250000, F.col("o_orderpriority")).alias("name"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("balance"),
    )
    return backfill(delta, full, "id", "seen", ["name", "balance"])


BACKFILL_PARTIAL = """
SELECT d.id, CAST(2 AS INTEGER) AS seen, coalesce(d.name, c_name) AS name,
       coalesce(d.balance, CASE WHEN c_acctbal > 0 THEN c_acctbal END) AS balance
FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS id,
             CASE WHEN o_totalprice > 250000 THEN o_orderpriority END AS name,
             CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS balance FROM orders) d
LEFT JOIN customer ON d.id = c_custkey
"""


def _stored_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("id"),
        F.when(F.col("o_totalprice") > 50000, F.col("o_orderdate")).alias("changed_at"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
    )


def _order_batch(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    moved = F.col("o_orderdate") + F.expr("INTERVAL '30' DAY")
    return orders.select(
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .when(F.col("o_orderstatus") == "F", -F.col("o_orderkey") - 1)
        .otherwise(F.col("o_orderkey"))
        .alias("id"),
        F.when(urgent, moved)
        .when(F.col("o_orderpriority") != "2-HIGH", F.col("o_orderdate"))
        .alias("changed_at"),
        F.lower("o_orderstatus").alias("status"),
        (F.col("o_totalprice") + 1).alias("price"),
    )


MERGE_INPUTS = """
WITH stored AS (
  SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS id,
         CASE WHEN o_totalprice > 50000 THEN o_orderdate END AS changed_at,
         o_orderstatus AS status, o_totalprice AS price FROM orders),
batch AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'F' THEN -o_orderkey - 1
              ELSE o_orderkey END AS id,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 30 DAY
              WHEN o_orderpriority <> '2-HIGH' THEN o_orderdate END AS changed_at,
         lower(o_orderstatus) AS status, o_totalprice + 1 AS price FROM orders)
"""

NEW_ROWS = "SELECT b.* FROM batch b WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.id = b.id)"


def newer_wins(spark, sf_dir):
    return merge_newer(_stored_orders(spark, sf_dir), _order_batch(spark, sf_dir), "id", "changed_at")


NEWER_WINS = f"""{MERGE_INPUTS}
SELECT s.id, CASE WHEN b.changed_at > s.changed_at THEN b.changed_at ELSE s.changed_at END AS changed_at,
       CASE WHEN b.changed_at > s.changed_at THEN b.status ELSE s.status END AS status,
       CASE WHEN b.changed_at > s.changed_at THEN b.price ELSE s.price END AS price
FROM stored s LEFT JOIN batch b ON s.id = b.id
UNION ALL {NEW_ROWS}
"""


def batch_wins(spark, sf_dir):
    return merge_always(_stored_orders(spark, sf_dir), _order_batch(spark, sf_dir), "id")


BATCH_WINS = f"""{MERGE_INPUTS}
SELECT s.* FROM stored s WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE s.id = b.id)
UNION ALL SELECT * FROM batch
"""


def insert_only(spark, sf_dir):
    return merge_insert(_stored_orders(spark, sf_dir), _order_batch(spark, sf_dir), "id")


INSERT_ONLY = f"{MERGE_INPUTS} SELECT * FROM stored UNION ALL {NEW_ROWS}"


def evolving(spark, sf_dir):
    batch = _order_batch(spark, sf_dir).withColumn("channel", F.upper("status")).drop("price")
    return merge_newer(_stored_orders(spark, sf_dir), batch, "id", "changed_at")


EVOLVING = f"""{MERGE_INPUTS}
SELECT s.id, CASE WHEN b.changed_at > s.changed_at THEN b.changed_at ELSE s.changed_at END AS changed_at,
       CASE WHEN b.changed_at > s.changed_at THEN b.status ELSE s.status END AS status,
       s.price, CASE WHEN b.changed_at > s.changed_at THEN upper(b.status) END AS channel
FROM stored s LEFT JOIN batch b ON s.id = b.id
UNION ALL
SELECT n.id, n.changed_at, n.status, NULL, upper(n.status) FROM ({NEW_ROWS}) n
"""


def evolving_inside(spark, sf_dir):
    """Structs, alone and in arrays, that get a field, another order and a wider number."""
    orders = table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    part = F.struct(F.col("o_orderstatus").alias("code"), F.col("o_custkey").cast("int").alias("n"))
    stored = orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("changed_at"),
        F.struct(
            F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.col("o_custkey").cast("int").alias("size")
        ).alias("detail"),
        F.array(part).alias("parts"),
    )
    wide = F.col("o_custkey") * 10_000_000_000
    part = F.struct(wide.alias("n"), F.lower("o_orderpriority").alias("unit"), F.col("o_orderpriority").alias("code"))
    batch = orders.select(
        F.struct(wide.alias("size"), F.lower("o_orderpriority").alias("channel"), (F.col("o_totalprice") + 1).alias("price")).alias("detail"),
        F.array(part, part).alias("parts"),
        F.when(F.col("o_orderstatus") == "F", -F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey")).alias("id"),
        F.when(urgent, F.col("o_orderdate") + F.expr("INTERVAL '30' DAY")).otherwise(F.col("o_orderdate")).alias("changed_at"),
    )
    return merge_newer(stored, batch, "id", "changed_at").select("id", "changed_at", "detail.*", F.size("parts").alias("parts"), F.inline("parts").alias("code", "n", "unit"))


EVOLVING_INSIDE = """
WITH meets AS (
  SELECT *, o_orderstatus <> 'F' AND o_orderpriority = '1-URGENT' AS updates FROM orders),
state AS (
  SELECT o_orderkey AS id, CASE WHEN updates THEN o_orderdate + INTERVAL 30 DAY ELSE o_orderdate END AS changed_at, o_orderstatus AS status,
    CASE WHEN updates THEN o_totalprice + 1 ELSE o_totalprice END AS price, CASE WHEN updates THEN o_custkey * 10000000000 ELSE o_custkey END AS size,
    CASE WHEN updates THEN lower(o_orderpriority) END AS channel, CASE WHEN updates THEN 2 ELSE 1 END AS parts,
    CASE WHEN updates THEN o_orderpriority ELSE o_orderstatus END AS code, CASE WHEN updates THEN o_custkey * 10000000000 ELSE o_custkey END AS n,
    CASE WHEN updates THEN lower(o_orderpriority) END AS unit FROM meets
  UNION ALL
  SELECT -o_orderkey - 1, CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 30 DAY ELSE o_orderdate END, NULL,
    o_totalprice + 1, o_custkey * 10000000000, lower(o_orderpriority), 2, o_orderpriority, o_custkey * 10000000000, lower(o_orderpriority)
  FROM orders WHERE o_orderstatus = 'F')
SELECT id, changed_at, status, price, size::BIGINT AS size, channel, parts::INTEGER AS parts, code, n::BIGINT AS n, unit
FROM (SELECT *, unnest(range(parts)) FROM state)
"""


def merged_with_changes(spark, sf_dir):
    """State and changed rows of one merge."""
    stored, batch = _stored_orders(spark, sf_dir), _order_batch(spark, sf_dir)
    return merge_with_changes(stored, batch, "id", "changed_at")


MERGED_WITH_CHANGES = f"""
WITH after_merge AS ({NEWER_WINS}), updated AS (
  {MERGE_INPUTS}
  SELECT s.id, s.changed_at, s.status, s.price, b.changed_at AS new_at, b.status AS new_status, b.price AS new_price
  FROM stored s JOIN batch b ON s.id = b.id AND b.changed_at > s.changed_at)
SELECT *, NULL AS _change_type, 'state' AS _output FROM after_merge
UNION ALL SELECT id, changed_at, status, price, 'update_preimage', 'changes' FROM updated
UNION ALL SELECT id, new_at, new_status, new_price, 'update_postimage', 'changes' FROM updated
UNION ALL SELECT n.*, 'insert', 'changes' FROM ({MERGE_INPUTS} {NEW_ROWS}) n
"""


def shared_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return duplicate_keys(lines, ["l_orderkey", "l_linenumber"]).withColumnRenamed("count", "n")


SHARED_KEYS = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1
"""


def snapshot_changes(spark, sf_dir):
    """Changes of all orders: altered, gone and new ones; those without a key are netted."""
    before = _stored_orders(spark, sf_dir)
    after = _order_batch(spark, sf_dir)
    untouched = before.join(after, "id", "left_semi").where("price > 250000")
    unnamed = before.where("id IS NULL AND price > 200000")
    after = after.where("price <= 250001").unionByName(untouched).unionByName(unnamed)
    return change_feed(before, after, "id")


SNAPSHOT_CHANGES = f"""{MERGE_INPUTS}, before_all AS (SELECT * FROM stored),
after_all AS (
  SELECT * FROM batch WHERE price <= 250001
  UNION ALL
  SELECT * FROM stored p WHERE price > 250000 AND EXISTS (SELECT 1 FROM batch b WHERE b.id = p.id)
  UNION ALL
  SELECT * FROM stored WHERE id IS NULL AND price > 200000),
prior AS (SELECT * FROM before_all WHERE id IS NOT NULL),
later AS (SELECT * FROM after_all WHERE id IS NOT NULL),
both_sides AS (
  SELECT p.id FROM prior p JOIN later l ON p.id = l.id
  WHERE p.changed_at IS DISTINCT FROM l.changed_at OR p.status IS DISTINCT FROM l.status
     OR p.price IS DISTINCT FROM l.price)
SELECT p.*, 'update_preimage' AS _change_type FROM prior p WHERE p.id IN (SELECT id FROM both_sides)
UNION ALL SELECT l.*, 'update_postimage' FROM later l WHERE l.id IN (SELECT id FROM both_sides)
UNION ALL SELECT p.*, 'delete' FROM prior p WHERE NOT EXISTS (SELECT 1 FROM later l WHERE l.id = p.id)
UNION ALL SELECT l.*, 'insert' FROM later l WHERE NOT EXISTS (SELECT 1 FROM prior p WHERE p.id = l.id)
UNION ALL SELECT *, 'delete' FROM (SELECT * FROM before_all WHERE id IS NULL EXCEPT ALL SELECT * FROM after_all WHERE id IS NULL)
UNION ALL SELECT *, 'insert' FROM (SELECT * FROM after_all WHERE id IS NULL EXCEPT ALL SELECT * FROM before_all WHERE id IS NULL)
"""

QUERIES = {
    "latest_per_key": Query(latest_rows, LATEST_ROWS),
    "latest_null_keys": Query(latest_null_keys, LATEST_NULL_KEYS),
    "latest_single_row": Query(latest_single_row, LATEST_SINGLE_ROW),
    "curated_assembly": Query(curated_assembly, CURATED_ASSEMBLY),
    "backfill": Query(backfill_partial, BACKFILL_PARTIAL),
    "merge_newer": Query(newer_wins, NEWER_WINS),
    "merge_always": Query(batch_wins, BATCH_WINS),
    "merge_insert": Query(insert_only, INSERT_ONLY),
    "merge_evolve": Query(evolving, EVOLVING),
    "merge_evolve_nested": Query(evolving_inside, EVOLVING_INSIDE),
    "merge_with_changes": Query(merged_with_changes, MERGED_WITH_CHANGES),
    "duplicate_keys": Query(shared_keys, SHARED_KEYS),
    "change_feed": Query(snapshot_changes, SNAPSHOT_CHANGES),
}
