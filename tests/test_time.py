"""Time handling does not depend on the session time zone."""

import datetime as dt

from pyspark.sql import functions as F

from attrlake.functions.time import event_date_from_micros, event_time, micros_to_ntz, ntz_to_micros

# one micro before 2024-01-01, the epoch, one micro before the epoch
MICROS = [1704067199999999, 0, -1]


def _rows(spark):
    df = spark.createDataFrame([(m,) for m in MICROS], "m bigint")
    return df.select(
        "m",
        micros_to_ntz("m").alias("t"),
        event_date_from_micros("m").alias("d"),
        ntz_to_micros(micros_to_ntz("m")).alias("back"),
    ).orderBy(F.col("m").desc()).collect()


def test_event_date_and_round_trip(spark):
    rows = _rows(spark)
    assert [r.d for r in rows] == [dt.date(2023, 12, 31), dt.date(1970, 1, 1), dt.date(1969, 12, 31)]
    assert [r.back for r in rows] == sorted(MICROS, reverse=True)
    assert rows[0].t == dt.datetime(2023, 12, 31, 23, 59, 59, 999999)


def test_same_result_in_another_session_zone(spark):
    utc = _rows(spark)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    try:
        assert _rows(spark) == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_event_time_is_utc_micros(spark):
    df = spark.createDataFrame([(1704067199999999,)], "m bigint")
    r = df.select(F.unix_micros(event_time(micros_to_ntz("m"))).alias("u")).first()
    assert r.u == 1704067199999999
