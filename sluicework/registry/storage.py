"""Scans, sinks, versions and control tables; what is written is read back whole."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from sluicework.operators.layout import compact, cut_lineage, table_metrics
from sluicework.plans.analytics import analytics_inputs, analytics_rows, run_analytics
from sluicework.plans.ingest import ingest, raw_path, stage
from sluicework.registry.common import Query, table
from sluicework.sources import control, sinks
from sluicework.sources.files import read_files, read_sheet, unwrap_envelope
from sluicework.sources.ledger import consume, read_unseen, unseen_files
from sluicework.sources.scratch import scratch_dir, written_out
from sluicework.sources.tables import compact_small_files, create_table, merge_table, read_load_changes, read_table
from sluicework.streaming.increments import file_stream, stream_into_table, stream_staging

INGESTED_AT = datetime(2024, 6, 20, 7, 5)
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def scan_incremental(spark, sf_dir):
    path = f"{sf_dir}/orders.parquet"
    schema = spark.read.parquet(path).schema
    return read_files(spark, path, control.NEVER_LOADED, "parquet", source="kafka", schema=schema)


def scan_nothing_new(spark, sf_dir):
    path = f"{sf_dir}/orders.parquet"
    schema = spark.read.parquet(path).schema
    return read_files(spark, path, "2200-01-01T00:00:00", "parquet", source="kafka", schema=schema)


def unwrap(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    wrapped = customer.select(F.struct(*customer.columns).alias("_airbyte_data"), F.lit(1).alias("_meta"))
    return unwrap_envelope(wrapped)


def sheet(spark, sf_dir):
    path = scratch_dir(spark)
    supplier = table(spark, sf_dir, "supplier").withColumn("s_name", F.when(F.col("s_acctbal") > 0, F.col("s_name")))
    supplier.write.mode("overwrite").option("header", "true").csv(path)
    text = read_sheet(spark, path)
    typed = read_sheet(spark, path, infer_types=True).select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return text.drop("s_acctbal").join(typed, F.col("s_suppkey") == F.col("key").cast("string")).drop("key")


SHEET = """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, CASE WHEN s_acctbal > 0 THEN s_name END AS s_name,
       CAST(s_nationkey AS VARCHAR) AS s_nationkey, s_nationkey AS nation, s_acctbal AS balance FROM supplier
"""


def partitioned(spark, sf_dir):
    path = scratch_dir(spark)
    sinks.write_partitioned(table(spark, sf_dir, "orders"), path, "o_orderstatus")
    return spark.read.parquet(path)


def staged(spark, sf_dir):
    source, target = scratch_dir(spark), scratch_dir(spark)
    orders = table(spark, sf_dir, "orders")
    orders.toDF("Key", "cust", "Status", "PRICE", "At", "priority").write.mode("overwrite").parquet(source)
    stage(spark, source, target, control.NEVER_LOADED, "parquet", day="2024-06-20")
    types = "key BIGINT, cust BIGINT, status STRING, price DOUBLE, at TIMESTAMP_NTZ, priority STRING"
    return spark.read.schema(types).json(f"{target}/2024-06-20")


STAGED = """
SELECT o_orderkey AS key, o_custkey AS cust, o_orderstatus AS status, o_totalprice AS price, o_orderdate AS at, o_orderpriority AS priority FROM orders
"""


def ingested(spark, sf_dir):
    path = raw_path(scratch_dir(spark), "mongo", "Shop", "Events")
    ingest(table(spark, sf_dir, "events"), path, INGESTED_AT, timestampNTZFormat=MICROS)
    types = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    return read_files(spark, path, None, "json", source="kafka", schema=types)


def raw_partitions(spark, sf_dir):
    """Events partitioned by their own hour, found again as partition columns."""
    path = scratch_dir(spark)
    ingest(table(spark, sf_dir, "events"), path, F.col("ts"), timestampNTZFormat=MICROS)
    types = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING, "
    return spark.read.schema(types + ", ".join(f"{c} INT" for c in sinks.INGEST_COLUMNS)).json(path)


RAW_PARTITIONS = """
SELECT *, CAST(year(ts) AS INTEGER) AS ingest_year, CAST(month(ts) AS INTEGER) AS ingest_month,
       CAST(day(ts) AS INTEGER) AS ingest_day, CAST(hour(ts) AS INTEGER) AS ingest_hour
FROM events
"""


def counted(spark, sf_dir):
    path = scratch_dir(spark)
    written = sinks.write_counted(table(spark, sf_dir, "part"), path, file_format="parquet", rows_per_file=1000)
    back = spark.read.parquet(path)
    return table_metrics(back).select(
        "row_count",
        (F.col("row_count") == written).alias("complete"),
        (F.col("num_files") == written // 1000 + 1).alias("as_many_files"),
    )


COUNTED = "SELECT count(*) AS row_count, true AS complete, true AS as_many_files FROM part"


def _control_rows(spark, sf_dir):
    never = F.lit(control.NEVER_LOADED)
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", never).otherwise("2024-01-01T00:00:00").alias("last_modified"),
        F.col("c_custkey").alias("row_count"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.lit("2023-01-01T00:00:00")).alias("created_at"),
    )


def control_first_load(spark, sf_dir):
    return control.with_first_load(_control_rows(spark, sf_dir))


CONTROL_ROWS = """
SELECT c_name AS name, c_custkey AS row_count, c_mktsegment = 'BUILDING' AS first_load,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '2016-01-01T00:00:00' ELSE '2024-01-01T00:00:00' END AS last_modified,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN '2023-01-01T00:00:00' END AS created_at, c_acctbal
FROM customer
"""


def control_update(spark, sf_dir):
    loads = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(
        F.col("c_name").alias("name"),
        F.lit("2024-06-20T00:00:00").alias("last_modified"),
        (F.col("c_custkey") + 7).alias("row_count"),
    )
    return control.advance(_control_rows(spark, sf_dir), loads)


CONTROL_UPDATE = f"""
SELECT name, CASE WHEN c_acctbal > 0 THEN '2024-06-20T00:00:00' ELSE last_modified END AS last_modified,
       CASE WHEN c_acctbal > 0 THEN row_count + 7 ELSE row_count END AS row_count,
       CASE WHEN c_acctbal > 0 AND first_load THEN '2024-06-20T00:00:00' ELSE created_at END AS created_at
FROM ({CONTROL_ROWS})
"""


def control_log(spark, sf_dir):
    """Two loads that both began with the same control rows, each appended on its own, one of them twice."""
    log = scratch_dir(spark)
    rows = _control_rows(spark, sf_dir)
    control.append_load(rows.withColumn("version", F.lit(0).cast("bigint")), log, "created")
    began = control.read_log(spark, log)
    odd = F.col("row_count") % 2 == 1

    def load(which, number):
        return began.where(which).select("name", (F.col("version") + number).alias("version"), (F.col("row_count") + number).alias("row_count"))

    control.append_load(load(odd, 1), log, "odd-1")
    control.append_load(load(~odd, 2), log, "even-2")
    control.append_load(load(odd, 1), log, "odd-1")
    name = began.agg(F.min("name")).first()[0]
    newest = control.latest_version(spark, log, name)
    return control.read_log(spark, log).withColumn("latest_of_first", F.when(F.col("name") == name, newest).cast("bigint"))


CONTROL_LOG = f"""
SELECT name, last_modified, created_at, CASE WHEN row_count % 2 = 1 THEN row_count + 1 ELSE row_count + 2 END AS row_count,
  CAST(CASE WHEN row_count % 2 = 1 THEN 1 ELSE 2 END AS BIGINT) AS version,
  CAST(CASE WHEN name = (SELECT min(name) FROM ({CONTROL_ROWS})) THEN CASE WHEN row_count % 2 = 1 THEN 1 ELSE 2 END END AS BIGINT) AS latest_of_first
FROM ({CONTROL_ROWS})
"""


def scan_ledger(spark, sf_dir):
    """Three loads by a ledger of files. Closed orders are written first but come last: their files are
    older than all that was seen. The third load finds nothing."""
    root = scratch_dir(spark)
    ledger, late, raw = f"{root}/ledger", f"{root}/late", f"{root}/raw"
    orders = table(spark, sf_dir, "orders")
    orders.where("o_orderstatus = 'F'").write.parquet(late)
    orders.where("o_orderstatus <> 'F'").write.parquet(raw)
    rows = None
    for load, paths in (("1", [raw]), ("2", [raw, late]), ("3", [raw, late])):
        files = written_out(unseen_files(spark, paths, ledger, load))
        found = read_unseen(spark, files, "parquet", orders.schema, source="kafka").withColumn("load", F.lit(load))
        consume(files, ledger, load)
        rows = found if rows is None else rows.unionByName(found)
    return rows


SCAN_LEDGER = "SELECT *, CASE WHEN o_orderstatus = 'F' THEN '2' ELSE '1' END AS load FROM orders"


def control_optimised(spark, sf_dir):
    """Upkeep of some tables recorded in their control rows; watermarks stay."""
    runs = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(
        F.col("c_name").alias("name"),
        F.lit("2024-06-21T00:00:00").alias("last_optimised"),
        (F.col("c_custkey") + 9).alias("row_count"),
    )
    return control.mark_optimised(_control_rows(spark, sf_dir), runs)


CONTROL_OPTIMISED = f"""
SELECT name, last_modified, CASE WHEN c_acctbal > 0 THEN row_count + 9 ELSE row_count END AS row_count, created_at,
       CASE WHEN c_acctbal > 0 THEN '2024-06-21T00:00:00' END AS last_optimised
FROM ({CONTROL_ROWS})
"""


def lineage_cut(spark, sf_dir):
    """A grouped table kept as checkpoint files and read again."""
    sums = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("most"))
    return cut_lineage(sums)


LINEAGE_CUT = "SELECT l_suppkey, count(*) AS n, max(l_quantity) AS most FROM lineitem GROUP BY l_suppkey"


def compacted(spark, sf_dir):
    path = scratch_dir(spark)
    lines = table(spark, sf_dir, "lineitem")
    size = table_metrics(lines).first()["size_in_bytes"]
    compact(lines, size, ["l_shipdate", "l_suppkey"], file_bytes=size // 4 + 1).write.parquet(path)
    return spark.read.parquet(path)


def metrics(spark, sf_dir):
    found = table_metrics(table(spark, sf_dir, "lineitem"))
    return found.select("row_count", "num_files", (F.col("size_in_bytes") > 0).alias("has_bytes"))


METRICS = "SELECT count(*) AS row_count, CAST(1 AS BIGINT) AS num_files, true AS has_bytes FROM lineitem"


def _later_orders(orders, days):
    """All orders with a newer date and twice the price; dear ones are new orders."""
    later = orders.withColumn("o_orderdate", F.col("o_orderdate") + F.expr(f"INTERVAL '{days}' DAY")).withColumn(
        "o_totalprice", F.col("o_totalprice") * 2
    )
    dear = F.col("o_totalprice") > 500000
    return later.withColumn("o_orderkey", F.when(dear, -F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey")))


def merge_touched(spark, sf_dir):
    """Open orders change in a table by status; files of other statuses stay as they are."""
    path = scratch_dir(spark)
    orders = table(spark, sf_dir, "orders")
    create_table(orders, path, "o_orderstatus")
    file_path = F.col("_metadata.file_path")

    def files():
        state = spark.read.parquet(f"{path}/_output=state").where("_change_type IS NULL")
        return state.groupBy("o_orderstatus").agg(F.sort_array(F.collect_set(file_path)).alias("files"))

    before = written_out(files())
    merge_table(spark, path, _later_orders(orders.where("o_orderstatus = 'O'"), 1), "o_orderkey", "o_orderstatus", 1, "o_orderdate")
    same = before.join(files().withColumnRenamed("files", "now"), "o_orderstatus").select(
        "o_orderstatus", (F.col("files") == F.col("now")).alias("same_files")
    )
    return read_table(spark, path).join(same, "o_orderstatus")


MERGE_TOUCHED = """
WITH later AS (
  SELECT *, o_totalprice * 2 > 500000 AS dear FROM orders WHERE o_orderstatus = 'O')
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, true AS same_files FROM orders WHERE o_orderstatus <> 'O'
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN dear THEN o_totalprice ELSE o_totalprice * 2 END,
  CASE WHEN dear THEN o_orderdate ELSE o_orderdate + INTERVAL 1 DAY END, o_orderpriority, false FROM later
UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice * 2, o_orderdate + INTERVAL 1 DAY, o_orderpriority, false FROM later WHERE dear
"""


def compact_small(spark, sf_dir):
    """Open orders arrive in three loads of their own; their partition alone is made one file again."""
    path = scratch_dir(spark)
    orders = table(spark, sf_dir, "orders")
    create_table(orders.where("o_orderstatus <> 'O'"), path, "o_orderstatus")
    for load in (1, 2, 3):
        part = orders.where(f"o_orderstatus = 'O' AND o_orderkey % 3 = {load - 1}")
        merge_table(spark, path, part, "o_orderkey", "o_orderstatus", load, "o_orderdate")

    def files():
        state = spark.read.parquet(f"{path}/_output=state")
        return state.groupBy("o_orderstatus").agg(F.sort_array(F.collect_set("_metadata.file_path")).alias("files"))

    before = written_out(files())
    compact_small_files(spark, path, "o_orderstatus")
    same = before.join(files().withColumnRenamed("files", "now"), "o_orderstatus").select(
        "o_orderstatus", (F.col("files") == F.col("now")).alias("same_files"), F.size("files").alias("files_before"), F.size("now").alias("files_after")
    )
    return read_table(spark, path).join(same, "o_orderstatus")


COMPACT_SMALL = """
SELECT *, o_orderstatus <> 'O' AS same_files, CAST(CASE o_orderstatus WHEN 'O' THEN 3 ELSE 1 END AS INTEGER) AS files_before,
  CAST(1 AS INTEGER) AS files_after FROM orders
"""


def changes_of_three_loads(spark, sf_dir):
    """What three loads changed together: prices double twice, new orders come and change, a status moves.
    The changes are those kept by the loads; no state is read."""
    path = scratch_dir(spark)
    orders = table(spark, sf_dir, "orders")
    create_table(orders.where("o_orderstatus <> 'P'"), path, "o_orderstatus")
    some = orders.where("o_orderpriority IN ('1-URGENT', '2-HIGH')")
    closed = some.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "O", F.lit("C")).otherwise(F.col("o_orderstatus")))
    for load, batch, days in ((1, orders.where("o_orderstatus = 'P'"), 0), (2, some, 1), (3, closed, 2)):
        newer = batch.withColumn("o_orderdate", F.col("o_orderdate") + F.make_dt_interval(F.lit(days))).withColumn("o_totalprice", F.col("o_totalprice") * (days + 1))
        merge_table(spark, path, newer, "o_orderkey", "o_orderstatus", load, "o_orderdate")
    return read_load_changes(spark, path, "o_orderkey", 0, 3)


CHANGES_OF_THREE_LOADS = """
WITH ends AS (
  SELECT *, o_orderpriority IN ('1-URGENT', '2-HIGH') AS moved FROM orders)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 'update_preimage' AS _change_type
FROM ends WHERE moved AND o_orderstatus <> 'P'
UNION ALL
SELECT o_orderkey, o_custkey, CASE WHEN moved AND o_orderstatus = 'O' THEN 'C' ELSE o_orderstatus END, CASE WHEN moved THEN o_totalprice * 3 ELSE o_totalprice END,
  CASE WHEN moved THEN o_orderdate + INTERVAL 2 DAY ELSE o_orderdate END, o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN 'insert' ELSE 'update_postimage' END
FROM ends WHERE moved OR o_orderstatus = 'P'
"""


def upsert_and_append(spark, sf_dir):
    """The load layer's names for its two merges: newer orders replace stored ones, then missing ones are added."""
    orders = table(spark, sf_dir, "orders")
    stored = orders.where("o_orderstatus <> 'P'")
    open_ones = orders.where("o_orderstatus = 'O'").withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL '1' DAY"))
    state = sinks.upsert(stored, open_ones, "o_orderkey", "o_orderdate")
    return sinks.append(state, orders.withColumn("o_totalprice", -F.col("o_totalprice")), "o_orderkey")


UPSERT_AND_APPEND = """
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate, o_orderpriority FROM orders
"""


def analytics_changes(spark, sf_dir):
    """Orders loaded twice; user SQL over what the second load changed, as that load kept it."""
    path = scratch_dir(spark)
    orders = table(spark, sf_dir, "orders")
    create_table(orders, path, "o_orderstatus")
    batch = _later_orders(orders, 1).where("o_orderstatus = 'O'")
    merge_table(spark, path, batch, "o_orderkey", "o_orderstatus", 1, "o_orderdate")
    rows = spark.range(1).select(
        F.lit("orders_curated").alias("name"),
        F.lit(path).alias("path"),
        F.lit("1").alias("version"),
        F.lit("o_orderkey").alias("unique_id"),
        F.lit("2024-01-01T00:00:00").alias("last_modified"),
    )
    inputs = analytics_inputs(spark, rows, "orders_curated", first_load=False)
    return analytics_rows(
        spark,
        inputs,
        "SELECT _change_type AS change, year(o_orderdate) AS y, o_orderpriority AS priority, count(*) AS n, min(o_custkey) AS least, "
        "max(o_totalprice) AS dearest FROM orders_curated GROUP BY 1, 2, 3",
    )


ANALYTICS_CHANGES = """
SELECT CASE WHEN o_totalprice * 2 > 500000 THEN 'insert' ELSE 'update_postimage' END AS change,
       CAST(year(o_orderdate + INTERVAL 1 DAY) AS INTEGER) AS y, o_orderpriority AS priority, count(*) AS n,
       min(o_custkey) AS least, max(o_totalprice * 2) AS dearest
FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2, 3
"""


def analytics_runs(spark, sf_dir):
    """An analytics table by its control row: a first load, one after two loads of its source, one after none."""
    root = scratch_dir(spark)
    orders = table(spark, sf_dir, "orders")
    path = f"{root}/orders"
    create_table(orders.where("o_orderstatus <> 'P'"), path, "o_orderstatus")
    analytics = spark.createDataFrame(
        [("by_year", "orders", f"{root}/by_year", "id", "y", "changed_at", control.NEVER_LOADED, None, None)],
        "name STRING, sources STRING, path STRING, unique_id STRING, partition_columns STRING, incremental_key STRING, "
        "last_modified STRING, version BIGINT, source_versions MAP<STRING, BIGINT>",
    )

    def run(rows, version):
        curated = spark.createDataFrame([("orders", path, version, "o_orderkey")], "name STRING, path STRING, version BIGINT, unique_id STRING")
        query = "SELECT o_orderkey AS id, o_orderdate AS changed_at, year(o_orderdate) AS y, o_custkey AS who, o_totalprice AS price FROM orders"
        return written_out(run_analytics(spark, "by_year", rows, curated, query, f"2024-06-2{version}T00:00:00"))

    analytics = run(analytics, 0)
    for load, batch in ((1, orders.where("o_orderstatus = 'P'")), (2, _later_orders(orders.where("o_orderstatus = 'O'"), 400))):
        merge_table(spark, path, batch, "o_orderkey", "o_orderstatus", load, "o_orderdate")
    analytics = run(run(analytics, 2), 2)
    seen = analytics.select("version", F.col("source_versions")["orders"].alias("source_version"), "last_modified")
    return read_table(spark, f"{root}/by_year").join(F.broadcast(seen))


ANALYTICS_RUNS = """
WITH later AS (
  SELECT *, o_totalprice * 2 > 500000 AS dear FROM orders WHERE o_orderstatus = 'O'),
state AS (
  SELECT o_orderkey AS id, o_orderdate AS changed_at, o_custkey AS who, o_totalprice AS price FROM orders WHERE o_orderstatus <> 'O'
  UNION ALL SELECT o_orderkey, CASE WHEN dear THEN o_orderdate ELSE o_orderdate + INTERVAL 400 DAY END, o_custkey, CASE WHEN dear THEN o_totalprice ELSE o_totalprice * 2 END FROM later
  UNION ALL SELECT -o_orderkey - 1, o_orderdate + INTERVAL 400 DAY, o_custkey, o_totalprice * 2 FROM later WHERE dear)
SELECT id, changed_at, CAST(year(changed_at) AS INTEGER) AS y, who, price, CAST(1 AS BIGINT) AS version, CAST(2 AS BIGINT) AS source_version,
  '2024-06-22T00:00:00' AS last_modified FROM state
"""


def streamed_staging(spark, sf_dir):
    root = scratch_dir(spark)
    types = "Supp BIGINT, NAME STRING, Nation INT, acctBal DOUBLE"
    suppliers = table(spark, sf_dir, "supplier").toDF("Supp", "NAME", "Nation", "acctBal")
    suppliers.write.json(f"{root}/raw")
    stream = file_stream(spark, f"{root}/raw", "json", types)
    stream_staging(stream, f"{root}/staged", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema("supp BIGINT, name STRING, nation INT, acctbal DOUBLE").json(f"{root}/staged")


STREAMED_STAGING = "SELECT s_suppkey AS supp, s_name AS name, s_nationkey AS nation, s_acctbal AS acctbal FROM supplier"


def streamed_merge(spark, sf_dir):
    """Two file drops of all orders, the second with newer dates for open ones."""
    root = scratch_dir(spark)
    orders = table(spark, sf_dir, "orders")
    later = orders.withColumn(
        "o_orderdate",
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate") + F.expr("INTERVAL '9' DAY")).otherwise(
            F.col("o_orderdate")
        ),
    ).withColumn("o_totalprice", -F.col("o_totalprice"))
    for drop in (orders, later):
        drop.write.mode("append").parquet(f"{root}/raw")
        stream = file_stream(spark, f"{root}/raw", "parquet", orders.schema)
        stream_into_table(
            stream, f"{root}/table", "o_orderkey", "o_orderdate", "o_orderstatus", f"{root}/checkpoint"
        ).awaitTermination()
    return read_table(spark, f"{root}/table")


STREAMED_MERGE = """
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 9 DAY ELSE o_orderdate END AS o_orderdate, o_orderpriority
FROM orders
"""

QUERIES = {
    "scan_incremental": Query(scan_incremental, "SELECT * FROM orders"),
    "scan_nothing_new": Query(scan_nothing_new, "SELECT * FROM orders WHERE false"),
    "unwrap_envelope": Query(unwrap, "SELECT * FROM customer"),
    "read_sheet": Query(sheet, SHEET),
    "write_partitioned": Query(partitioned, "SELECT * FROM orders"),
    "write_staging": Query(staged, STAGED),
    "ingest_sized": Query(ingested, "SELECT * FROM events"),
    "raw_partitions": Query(raw_partitions, RAW_PARTITIONS),
    "write_counted": Query(counted, COUNTED),
    "control_first_load": Query(
        control_first_load, f"SELECT name, last_modified, row_count, created_at, first_load FROM ({CONTROL_ROWS})"
    ),
    "control_update": Query(control_update, CONTROL_UPDATE),
    "control_log": Query(control_log, CONTROL_LOG),
    "scan_ledger": Query(scan_ledger, SCAN_LEDGER),
    "control_optimised": Query(control_optimised, CONTROL_OPTIMISED),
    "cut_lineage": Query(lineage_cut, LINEAGE_CUT),
    "compact": Query(compacted, "SELECT * FROM lineitem"),
    "table_metrics": Query(metrics, METRICS),
    "merge_touched": Query(merge_touched, MERGE_TOUCHED),
    "compact_small": Query(compact_small, COMPACT_SMALL),
    "changes_of_three_loads": Query(changes_of_three_loads, CHANGES_OF_THREE_LOADS),
    "upsert_and_append": Query(upsert_and_append, UPSERT_AND_APPEND),
    "analytics_changes": Query(analytics_changes, ANALYTICS_CHANGES),
    "analytics_runs": Query(analytics_runs, ANALYTICS_RUNS),
    "stream_staging": Query(streamed_staging, STREAMED_STAGING),
    "stream_merge": Query(streamed_merge, STREAMED_MERGE),
}
