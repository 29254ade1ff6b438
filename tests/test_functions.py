from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sluicework import functions as fn


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.fixture
def zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")

    def use(name):
        spark.conf.set("spark.sql.session.timeZone", name)

    yield use
    spark.conf.set("spark.sql.session.timeZone", before)


def test_epoch_to_timestamp_is_an_instant(spark, zone):
    for name, text in (("Asia/Kolkata", "2024-06-20 08:05:38"), ("UTC", "2024-06-20 02:35:38")):
        zone(name)
        assert value(spark, fn.epoch_to_timestamp(F.lit(1718850938)).cast("string")) == text


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_wall_clocks_ignore_the_session_zone(spark, zone, session_zone):
    zone(session_zone)
    expected = datetime(2024, 6, 20, 8, 5, 38)
    assert value(spark, fn.epoch_to_ist(F.lit(1718850938))) == expected
    assert value(spark, fn.any_epoch_to_ist(F.lit("1718850938123"))) == expected
    assert value(spark, fn.string_to_ist(F.lit("2024-06-20T02:35:38.000Z"))) == expected
    assert value(spark, fn.utc_to_ist(F.lit("2024-06-20 02:35:38"))) == expected
    # 02:30 does not exist in New York on this day.
    assert value(spark, fn.string_to_timestamp(F.lit("2024-03-10 02:30:00"), "%Y-%m-%d %H:%M:%S")) == datetime(
        2024, 3, 10, 2, 30
    )


def test_epochs(spark):
    assert value(spark, fn.any_epoch_to_ist(F.lit(-1))) == datetime(1970, 1, 1, 5, 29, 59)
    assert value(spark, fn.any_epoch_to_ist(F.lit(999_999_999_999), keep_millis=True)) == datetime(
        2001, 9, 9, 7, 16, 39, 999000
    )
    assert value(spark, fn.any_epoch_to_ist(F.lit("soon"))) is None
    assert value(spark, fn.epoch_to_ist(F.lit(None).cast("bigint"))) is None


def test_convert_timezone_from_any_zone(spark):
    midnight = F.lit("2024-06-20 00:00:00")
    assert value(spark, fn.convert_timezone(midnight, "Asia/Kolkata", "UTC")) == datetime(2024, 6, 19, 18, 30)
    assert value(spark, fn.convert_timezone(midnight, "UTC", "America/New_York")) == datetime(2024, 6, 19, 20)
    assert value(spark, fn.utc_to_ist(F.lit("never"))) is None


def test_string_formats(spark):
    assert fn.java_pattern("%Y-%m-%dT%H o'clock") == "yyyy'-'MM'-'dd'T'HH' o''clock'"
    assert value(spark, fn.string_to_timestamp(F.lit("20/06/24 x"), "%d/%m/%Y")) is None
    assert value(spark, fn.string_to_timestamp(F.lit(None).cast("string"), "%d/%m/%Y")) is None
    for bad in ("2024-06-20T02:35:38Z", "2024-02-30T02:35:38.000Z", "2024-06-20T24:00:00.000Z", "2024-06-20 02:35:38.000"):
        assert value(spark, fn.string_to_ist(F.lit(bad))) is None
    assert value(spark, fn.string_to_ist(F.lit("20240620"), "%Y%m%d")) == datetime(2024, 6, 20, 5, 30)
    with pytest.raises(ValueError, match="%j"):
        fn.java_pattern("%Y-%j")


def test_year_frac_and_age(spark):
    from_dt, to_dt = F.lit(datetime(2023, 5, 1)), F.lit(datetime(2024, 6, 20))
    assert value(spark, fn.year_frac(from_dt, to_dt)) == pytest.approx(1.1344086025, abs=1e-10)
    as_of = F.lit(date(2024, 6, 20))
    for born, age in ((date(2000, 6, 20), 24), (date(2000, 6, 21), 23), (date(2024, 6, 21), 0)):
        assert value(spark, fn.age_in_years(F.lit(born), as_of)) == age
    assert value(spark, fn.year_text(F.lit(date(1999, 1, 2)))) == "1999"


def test_sha256(spark):
    known = "91d17428d146fdbc804cb441daf689de97679bf6aee2ba4fb9e5920d7e174664"
    assert value(spark, fn.sha256_hash(F.lit("pyspark"))) == known
    assert value(spark, fn.sha256_hash(F.lit("pyspark"), 0)) == known
    assert value(spark, fn.hash_pii(F.lit(None).cast("string"))) is None
    with pytest.raises(ValueError):
        fn.sha256_hash("name", 128)


def test_array_to_string(spark):
    for array, text in (
        (F.array(F.lit("a"), F.lit('b"[c]'), F.lit(None)), "a, bc, null"),
        (F.array(F.struct(F.lit(1).alias("n"), F.lit("q").alias("t"))), "{1, q}"),
        (F.lit(None).cast("array<string>"), None),
        (F.array().cast("array<string>"), ""),
    ):
        assert value(spark, fn.array_to_string(array)) == text


def test_what_does_not_fit_is_null(spark):
    bad = spark.sql(f"SELECT 'nonsense' AS text, {2**63 - 1} AS high, {-(2**63)} AS low, date'2024-06-20' AS day")
    found = bad.select(
        fn.year_text("text"),
        fn.age_in_years("text", F.col("day")),
        fn.year_frac("text", "day"),
        fn.year_frac("day", "text"),
        fn.epoch_to_timestamp("high"),
        fn.epoch_to_timestamp("low"),
        fn.epoch_to_timestamp("text"),
        fn.epoch_to_ist("high"),
        fn.any_epoch_to_ist("high"),
        fn.any_epoch_to_ist("low"),
        fn.any_epoch_to_ist("low", keep_millis=True),
    )
    assert tuple(found.first()) == (None,) * 11
