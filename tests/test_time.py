import datetime as dt

import pytest
from pyspark.sql import functions as F

from series_lake.functions import timeconv as tc

CASES = [0, 999, -1500, -1, 1711111111999, 1730615400000, 1730619000000, -62000000000000, 1710054000000]
EPOCH = dt.datetime(1970, 1, 1)


@pytest.fixture(params=["UTC", "Asia/Tokyo", "America/Chicago", "Asia/Kolkata"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def times(spark):
    return spark.createDataFrame([(m,) for m in CASES], "ms long")


def test_clocks(spark, zone):
    ms = F.col("ms")
    rows = times(spark).select(
        ms, tc.ms_to_ntz(ms).alias("utc"), tc.clock_text(ms).alias("text"), tc.local_clock(ms).alias("local"), tc.utc_date(ms).alias("day")
    ).collect()
    got = {r.ms: r for r in rows}
    for m in CASES:
        assert got[m].utc == EPOCH + dt.timedelta(milliseconds=m)
        assert got[m].day == got[m].utc.date()
    assert got[-1500].text == "1969-12-31 23:59:59"
    assert got[1711111111999].text == "2024-03-22 12:38:31"
    assert str(got[1711111111999].local) == "2024-03-22 07:38:31"
    assert str(got[1730615400000].local) == str(got[1730619000000].local) == "2024-11-03 01:30:00"


def test_ntz_to_ms_in_every_session_zone(spark, zone):
    # 2024-03-10 02:30 does not exist in Chicago, 2024-11-03 01:30 exists twice
    clocks = ["2024-03-10 02:30:00.123456", "2024-11-03 01:30:00", "1969-12-31 23:59:58.5", "1900-01-01 00:00:00", "2024-01-01 23:59:59.999999"]
    frame = spark.createDataFrame([(c,) for c in clocks], "c string").select("c", F.col("c").cast("timestamp_ntz").alias("ts"))
    for row in frame.select("ts", tc.ntz_to_ms("ts").alias("ms"), tc.day_start_ms("ts").alias("day")).collect():
        assert row.ms == (row.ts - EPOCH) // dt.timedelta(milliseconds=1)
        assert row.day == (dt.datetime.combine(row.ts.date(), dt.time()) - EPOCH) // dt.timedelta(milliseconds=1)


def test_seconds(spark):
    assert spark.range(1).select(tc.ms_to_seconds(F.lit(1500)).alias("s")).first().s == 1.5


@pytest.mark.parametrize("target", ["America/Chicago", "UTC", "Asia/Kolkata", "Australia/Lord_Howe"])
def test_local_clock_equals_zone_conversion(spark, zone, target):
    # every 37 minutes and 1 ms over 1965 to 2035, clock changes included
    ms = spark.range(0, 1_000_000).select((F.col("id") * 2_220_001 - 157_766_400_000).alias("ms"))
    direct = F.convert_timezone(F.lit("UTC"), F.lit(target), tc.utc_seconds_clock(F.col("ms")))
    assert ms.where(~direct.eqNullSafe(tc.local_clock(F.col("ms"), target))).count() == 0
