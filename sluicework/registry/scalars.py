"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluicework import functions as fn
from sluicework.registry.common import Query, table


def _epoch(ts: str) -> Column:
    return F.unix_timestamp(F.col(ts).cast("timestamp"))


def epoch_to_ts(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        fn.epoch_to_timestamp(_epoch("ts")).cast("timestamp_ntz").alias("at"),
    )


EPOCH_TO_TS = "SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS at FROM events"


def utc_to_ist(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        fn.utc_to_ist("ts").alias("ist"),
        fn.utc_to_ist(F.col("ts").cast("string")).alias("ist_from_text"),
        fn.utc_to_ist("event_type").alias("ist_from_word"),
    )


UTC_TO_IST = """
SELECT event_id, ts + INTERVAL 330 MINUTE AS ist, ts + INTERVAL 330 MINUTE AS ist_from_text,
       CAST(NULL AS TIMESTAMP) AS ist_from_word
FROM events
"""


def tz_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    to_utc = fn.convert_timezone("ts", "Asia/Kolkata", "UTC")
    return events.select(
        "event_id",
        to_utc.alias("utc"),
        fn.convert_timezone(to_utc, "UTC", "Asia/Kolkata").alias("back"),
        fn.convert_timezone("ts", "Asia/Kolkata", "Asia/Tokyo").alias("tokyo"),
    )


TZ_ROUNDTRIP = """
SELECT event_id, ts - INTERVAL 330 MINUTE AS utc, ts AS back, ts + INTERVAL 210 MINUTE AS tokyo
FROM events
"""


def epoch_to_ist(spark, sf_dir):
    # Any number within the second: an id of 1000 or more would be of a later one, null of none.
    within = F.coalesce(F.pmod("user_id", F.lit(1000)), F.lit(0))
    millis = (_epoch("ts") * 1000 + within).cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id",
        fn.epoch_to_ist(_epoch("ts")).alias("ist"),
        fn.any_epoch_to_ist(_epoch("ts")).alias("ist_from_seconds"),
        fn.any_epoch_to_ist(millis).alias("ist_from_millis"),
        fn.any_epoch_to_ist("event_type").alias("ist_from_word"),
    )


EPOCH_TO_IST = """
SELECT event_id, s AS ist, s AS ist_from_seconds, s AS ist_from_millis,
       CAST(NULL AS TIMESTAMP) AS ist_from_word
FROM (SELECT event_id, date_trunc('second', ts)::TIMESTAMP + INTERVAL 330 MINUTE AS s FROM events)
"""


def str_to_ist(spark, sf_dir):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(iso)
    return table(spark, sf_dir, "events").select("event_id", fn.string_to_ist(text).alias("ist"))


STR_TO_IST = """
SELECT event_id,
       CASE WHEN event_type <> 'error'
            THEN date_trunc('millisecond', ts)::TIMESTAMP + INTERVAL 330 MINUTE END AS ist
FROM events
"""


def str_to_timestamp(spark, sf_dir):
    text = F.date_format("ts", "dd/MM/yyyy HH:mm:ss.SSSSSS")
    return table(spark, sf_dir, "events").select(
        "event_id",
        fn.string_to_timestamp(text, "%d/%m/%Y %H:%M:%S.%f").alias("at"),
        fn.string_to_ist(text, "%d/%m/%Y %H:%M:%S.%f").alias("ist"),
        fn.string_to_timestamp("props", "%Y-%m-%d").alias("not_a_date"),
    )


STR_TO_TIMESTAMP = """
SELECT event_id, ts AS at, ts + INTERVAL 330 MINUTE AS ist, CAST(NULL AS TIMESTAMP) AS not_a_date
FROM events
"""


def age_and_year(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.age_in_years("o_orderdate", F.lit("2024-06-20").cast("date")).alias("age"),
        fn.year_text("o_orderdate").alias("order_year"),
    )


AGE_AND_YEAR = """
SELECT o_orderkey,
       CAST(2024 - year(o_orderdate)
            - CASE WHEN month(o_orderdate) * 100 + day(o_orderdate) > 620 THEN 1 ELSE 0 END
            AS INTEGER) AS age,
       CAST(year(o_orderdate) AS VARCHAR) AS order_year
FROM orders
"""


def year_frac(spark, sf_dir):
    shipped = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    ordered = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return shipped.join(ordered, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_linenumber",
        fn.year_frac("o_orderdate", "l_shipdate").alias("years"),
    )


YEAR_FRAC = """
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN day(t) = day(f) OR (CAST(t AS DATE) = last_day(t) AND CAST(f AS DATE) = last_day(f))
                  THEN (year(t) - year(f)) * 12 + month(t) - month(f)
                  ELSE (year(t) - year(f)) * 12 + month(t) - month(f)
                     + ((day(t) - day(f)) * 86400 + (epoch(t) - epoch(date_trunc('day', t)))
                        - (epoch(f) - epoch(date_trunc('day', f)))) / (31 * 86400.0) END, 8) / 12 AS years
FROM (SELECT l_orderkey, l_linenumber, l_shipdate AS t, o_orderdate AS f
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


def hash_pii(spark, sf_dir):
    name = F.when(F.col("c_acctbal") >= 0, F.col("c_name"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        fn.hash_pii(name).alias("name_hash"),
        fn.sha256_hash("c_custkey").alias("key_hash"),
        F.length(fn.sha256_hash("c_name", 512)).alias("long_digits"),
    )


HASH_PII = """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN sha256(c_name) END AS name_hash,
       sha256(CAST(c_custkey AS VARCHAR)) AS key_hash, CAST(128 AS INTEGER) AS long_digits
FROM customer
"""


def array_to_string(spark, sf_dir):
    order = table(spark, sf_dir, "orders")
    words = F.array("o_orderpriority", F.lit('["x"]'), F.lit(None), F.col("o_orderstatus"))
    numbers = F.array("o_orderkey", "o_custkey")
    return order.select(
        "o_orderkey",
        fn.array_to_string(words).alias("words"),
        fn.array_to_string(numbers).alias("numbers"),
        fn.array_to_string(F.when(F.col("o_orderstatus") == "O", words)).alias("open_words"),
    )


ARRAY_TO_STRING = """
SELECT o_orderkey, w AS words, concat(o_orderkey, ', ', o_custkey) AS numbers,
       CASE WHEN o_orderstatus = 'O' THEN w END AS open_words
FROM (SELECT *, concat(o_orderpriority, ', x, null, ', o_orderstatus) AS w FROM orders)
"""

QUERIES = {
    "epoch_to_ts": Query(epoch_to_ts, EPOCH_TO_TS),
    "utc_to_ist": Query(utc_to_ist, UTC_TO_IST),
    "tz_roundtrip": Query(tz_roundtrip, TZ_ROUNDTRIP),
    "epoch_to_ist": Query(epoch_to_ist, EPOCH_TO_IST),
    "str_to_ist": Query(str_to_ist, STR_TO_IST),
    "str_to_timestamp": Query(str_to_timestamp, STR_TO_TIMESTAMP),
    "age_and_year": Query(age_and_year, AGE_AND_YEAR),
    "year_frac": Query(year_frac, YEAR_FRAC),
    "hash_pii": Query(hash_pii, HASH_PII),
    "array_to_string": Query(array_to_string, ARRAY_TO_STRING),
}
