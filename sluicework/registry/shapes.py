"""Schema repair, filters, flattening and pivoting over whole tables.

Nested documents are built inside each row, so that their arrays are bounded.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sluicework.operators import nested, schema
from sluicework.registry.common import Query, table


def coalesce_dup_columns(spark, sf_dir):
    rich = F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment"))
    wide = table(spark, sf_dir, "customer").select("c_custkey", rich, "c_name", "c_mktsegment")
    named = wide.toDF("ID", "Label", "label", "Segment")
    return schema.rename_duplicate_columns(named)


COALESCE_DUP_COLUMNS = """
SELECT c_custkey AS id, c_mktsegment AS segment,
       coalesce(CASE WHEN c_acctbal > 5000 THEN c_mktsegment END, c_name) AS label
FROM customer
"""


def keep_last_dup_column(spark, sf_dir):
    order = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_custkey"
    )
    return schema.remove_duplicate_columns(order.toDF("id", "tag", "price", "tag", "id"))


KEEP_LAST_DUP_COLUMN = """
SELECT o_totalprice AS price, o_orderpriority AS tag, o_custkey AS id FROM orders
"""


def filter_not_null(spark, sf_dir):
    order = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 250000, F.col("o_orderpriority")).alias("urgency"),
    )
    return schema.filter_column(order, "urgency", "null")


FILTER_NOT_NULL = """
SELECT o_orderkey, o_orderpriority AS urgency FROM orders
WHERE o_totalprice > 250000 AND o_orderpriority IS NOT NULL
"""


def filter_ci(spark, sf_dir):
    order = table(spark, sf_dir, "orders")
    entries = [
        {"column": "o_orderpriority", "value": "1-Urgent"},
        {"column": "o_orderstatus", "value": "f"},
        {"column": "o_custkey", "value": "null"},
    ]
    return schema.apply_filters(order, entries).select("o_orderkey", "o_custkey", "o_totalprice")


FILTER_CI = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE lower(o_orderpriority) = '1-urgent' AND lower(o_orderstatus) = 'f' AND o_custkey IS NOT NULL
"""


def derived_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return schema.select_with_key(
        lines,
        ["l_partkey", "l_quantity"],
        "line_id",
        "concat_ws('-', l_orderkey, l_linenumber, l_suppkey)",
    )


DERIVED_KEY = """
SELECT l_partkey, l_quantity, concat_ws('-', l_orderkey, l_linenumber, l_suppkey) AS line_id
FROM lineitem
"""


def line_documents(spark, sf_dir):
    """A document per line: structs in structs, and an array that may be empty or null."""

    def charge(kind, amount):
        return F.struct(F.lit(kind).alias("kind"), F.col(amount).alias("amount"))

    charges = (
        F.when(F.col("l_returnflag") == "R", F.array(charge("price", "l_extendedprice")))
        .when(
            F.col("l_returnflag") == "A",
            F.array(charge("price", "l_extendedprice"), charge("tax", "l_tax")),
        )
        .when(
            F.col("l_linestatus") == "F",
            F.filter(F.array(charge("none", "l_tax")), lambda c: F.lit(False)),
        )
    )
    supplier = F.struct(F.col("l_suppkey").alias("key"), F.col("l_returnflag").alias("flag"))
    item = F.struct(F.col("l_partkey").alias("part"), supplier.alias("supplier"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.when(F.col("l_linenumber") < 7, item).alias("item"),
        charges.alias("charges"),
        F.col("l_quantity").alias("quantity"),
    )


LINES_FLAT = """
SELECT l_orderkey AS id, l_quantity AS quantity,
       CASE WHEN l_linenumber < 7 THEN l_partkey END AS item_part,
       CASE WHEN l_linenumber < 7 THEN l_suppkey END AS item_supplier_key,
       CASE WHEN l_linenumber < 7 THEN l_returnflag END AS item_supplier_flag,
       l_returnflag, l_linestatus, l_extendedprice, l_tax
FROM lineitem
"""


def flatten_documents(spark, sf_dir):
    return nested.flatten(line_documents(spark, sf_dir))


FLATTEN_DOCUMENTS = f"""
WITH lines AS ({LINES_FLAT})
SELECT id, quantity, item_part, item_supplier_key, item_supplier_flag,
       CASE WHEN l_returnflag IN ('A', 'R') THEN 'price' END AS charges_kind,
       CASE WHEN l_returnflag IN ('A', 'R') THEN l_extendedprice END AS charges_amount
FROM lines
UNION ALL
SELECT id, quantity, item_part, item_supplier_key, item_supplier_flag, 'tax', l_tax
FROM lines WHERE l_returnflag = 'A'
"""


def flatten_two_arrays(spark, sf_dir):
    order = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.array("o_orderstatus", F.substring("o_orderpriority", 1, 1)).alias("tags"),
        F.array(F.lit(1), F.lit(2), F.year("o_orderdate")).alias("steps"),
        F.create_map(F.lit("cust"), F.col("o_custkey")).alias("refs"),
    )
    flat = nested.flatten(order, max_arrays=2)
    return flat.select("o_orderkey", F.col("refs")["cust"].alias("cust"), "tags", "steps")


FLATTEN_TWO_ARRAYS = """
SELECT o_orderkey, o_custkey AS cust, tags, steps
FROM (SELECT o_orderkey, o_custkey, steps,
             unnest([o_orderstatus, substring(o_orderpriority, 1, 1)]) AS tags
      FROM (SELECT *, unnest([1, 2, CAST(year(o_orderdate) AS INTEGER)]) AS steps FROM orders))
"""


def flatten_policies(spark, sf_dir):
    documents = line_documents(spark, sf_dir).select(
        "*",
        F.array(F.lit("a"), F.col("item.supplier.flag")).alias("notes"),
        F.struct(F.array("quantity", "id").alias("list"), F.lit(1).alias("one")).alias("extra"),
    )
    return nested.flatten_documents(documents, {"charges": nested.EXPLODE})


FLATTEN_POLICIES = f"""
WITH lines AS ({LINES_FLAT}), charged AS (
  SELECT *, CASE WHEN l_returnflag IN ('A', 'R') THEN 'price' END AS charges_kind,
         CASE WHEN l_returnflag IN ('A', 'R') THEN l_extendedprice END AS charges_amount FROM lines
  UNION ALL SELECT *, 'tax', l_tax FROM lines WHERE l_returnflag = 'A')
SELECT id, quantity, item_part, item_supplier_key, item_supplier_flag, charges_kind, charges_amount,
       concat('a, ', coalesce(item_supplier_flag, 'null')) AS notes,
       concat(CAST(quantity AS VARCHAR), ', ', CAST(id AS DOUBLE)) AS extra_list, CAST(1 AS INTEGER) AS extra_one
FROM charged
"""


def _readings(spark, sf_dir):
    """Per event an array of tagged readings; a tag may repeat, the array may be null."""
    tag = F.when(F.col("value") > 50, F.lit("high")).otherwise(F.lit("low"))
    reading = F.struct(tag.alias("tag"), F.col("value").alias("amount"), F.col("event_id").alias("ref"))
    fixed = F.struct(F.lit("low").alias("tag"), F.lit(-1.0).alias("amount"), F.lit(0).cast("bigint").alias("ref"))
    readings = F.when(F.col("event_type") != "error", F.array(reading, fixed))
    return table(spark, sf_dir, "events").select("event_id", "user_id", readings.alias("readings"))


def pivot_array_single(spark, sf_dir):
    plain = F.transform("readings", lambda r: F.struct(r["tag"].alias("tag"), r["amount"].alias("amount")))
    events = _readings(spark, sf_dir).withColumn("readings", plain)
    return nested.pivot(events, "readings", "tag")


PIVOT_ARRAY_SINGLE = """
SELECT event_id, user_id, CASE WHEN event_type <> 'error' AND value > 50 THEN value END AS high,
       CASE WHEN event_type <> 'error' THEN CASE WHEN value > 50 THEN -1.0::DOUBLE ELSE value END END AS low
FROM events
"""


def pivot_array_multi(spark, sf_dir):
    """Rows of one user merge: the least first element of each tag stays."""
    users = _readings(spark, sf_dir).drop("event_id")
    return nested.pivot(users, "readings", "tag", values=["high", "low"])


PIVOT_ARRAY_MULTI = """
WITH first_elements AS (
  SELECT user_id, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS tag, 1 AS place, value AS amount, event_id AS ref
  FROM events WHERE event_type <> 'error'
  UNION ALL
  SELECT user_id, 'low', 2, -1.0, 0 FROM events WHERE event_type <> 'error' AND value > 50),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, tag ORDER BY place, amount, ref) AS rn
  FROM first_elements)
SELECT e.user_id, h.amount AS high_amount, h.ref AS high_ref, l.amount AS low_amount, l.ref AS low_ref
FROM (SELECT DISTINCT user_id FROM events) e
LEFT JOIN ranked h ON h.user_id = e.user_id AND h.tag = 'high' AND h.rn = 1
LEFT JOIN ranked l ON l.user_id = e.user_id AND l.tag = 'low' AND l.rn = 1
"""


def pivot_in_flatten(spark, sf_dir):
    events = _readings(spark, sf_dir).withColumn("meta", F.struct(F.col("user_id").alias("who")))
    return nested.flatten_documents(events.drop("user_id"), {"readings": nested.Pivot("tag")})


PIVOT_IN_FLATTEN = """
SELECT event_id, user_id AS meta_who,
       CASE WHEN ok AND value > 50 THEN value END AS high_amount,
       CASE WHEN ok AND value > 50 THEN event_id END AS high_ref,
       CASE WHEN ok THEN CASE WHEN value > 50 THEN -1.0::DOUBLE ELSE value END END AS low_amount,
       CASE WHEN ok THEN CASE WHEN value > 50 THEN 0 ELSE event_id END END AS low_ref
FROM (SELECT *, event_type <> 'error' AS ok FROM events)
"""

def _threads(spark, sf_dir, key):
    """Whole conversations as documents; their turns are an array of varying length."""
    turns = table(spark, sf_dir, "conversations").withColumn("kind", key)
    turn = F.struct("turn", "role", "text", "kind")
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def flatten_chosen(spark, sf_dir):
    """Chosen columns flattened; the others, nested or not, do not come along."""
    threads = _threads(spark, sf_dir, F.lit("x")).withColumn("other", F.array(F.struct(F.lit(1).alias("a"))))
    return nested.flatten(threads, columns=["turns", "conv_id"])


FLATTEN_CHOSEN = """
SELECT conv_id, turn AS turns_turn, role AS turns_role, text AS turns_text, 'x' AS turns_kind FROM conversations
"""


def pivot_null_keys(spark, sf_dir):
    """Turns by their place; later ones have a null key, which makes no column."""
    kind = F.when(F.col("turn") == 0, "first").when(F.col("turn") == 1, "second")
    threads = _threads(spark, sf_dir, kind).withColumn("turns", F.transform("turns", lambda t: F.struct(t["kind"], t["text"])))
    return nested.pivot(threads, "turns", "kind")


PIVOT_NULL_KEYS = """
SELECT conv_id, min(text) FILTER (WHERE turn = 0) AS first, min(text) FILTER (WHERE turn = 1) AS second
FROM conversations GROUP BY conv_id
"""

QUERIES = {
    "coalesce_dup_columns": Query(coalesce_dup_columns, COALESCE_DUP_COLUMNS),
    "keep_last_dup_column": Query(keep_last_dup_column, KEEP_LAST_DUP_COLUMN),
    "filter_not_null": Query(filter_not_null, FILTER_NOT_NULL),
    "filter_ci": Query(filter_ci, FILTER_CI),
    "derived_key": Query(derived_key, DERIVED_KEY),
    "flatten_documents": Query(flatten_documents, FLATTEN_DOCUMENTS),
    "flatten_two_arrays": Query(flatten_two_arrays, FLATTEN_TWO_ARRAYS),
    "flatten_policies": Query(flatten_policies, FLATTEN_POLICIES),
    "pivot_array_single": Query(pivot_array_single, PIVOT_ARRAY_SINGLE),
    "pivot_array_multi": Query(pivot_array_multi, PIVOT_ARRAY_MULTI),
    "pivot_in_flatten": Query(pivot_in_flatten, PIVOT_IN_FLATTEN),
    "flatten_columns": Query(flatten_chosen, FLATTEN_CHOSEN),
    "pivot_null_keys": Query(pivot_null_keys, PIVOT_NULL_KEYS),
}
