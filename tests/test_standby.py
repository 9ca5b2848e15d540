"""Standby rows: parsing, ranges, offsets."""

import pytest
from pyspark.sql import functions as F

from obsledger.functions.timestamps import ensure_offset
from obsledger.operators.standby import normalize_standby

RAW = "entity_code string, observed_at string, submitted_posted_time string, submitted_actual_time string"
NY, LA, TOKYO = "America/New_York", "America/Los_Angeles", "Asia/Tokyo"

CASES = [
    (LA, " ak01 ", "2024-07-01 10:00:00", "2.5", None,
     [("AK01", "2024-07-01T10:00:00-07:00", "POSTED", 2)]),
    (NY, "MK01", "2024-07-01 10:00:00", "30", "25",
     [("MK01", "2024-07-01T10:00:00-04:00", "POSTED", 30),
      ("MK01", "2024-07-01T10:00:00-04:00", "ACTUAL", 25)]),
    (NY, "MK01", "2024-07-01 10:05:00", "1000.5", "1000.6",
     [("MK01", "2024-07-01T10:05:00-04:00", "POSTED", 1000)]),
    (NY, "MK01", "2024-07-01 10:10:00", "-0.4", "-0.6",
     [("MK01", "2024-07-01T10:10:00-04:00", "POSTED", 0)]),
    (NY, "MK01", "2024-07-01 10:15:00", "abc", "5f", []),
    (NY, "MK01", "2024-07-01 10:15:00", "Infinity", "NaN", []),
    (NY, "MK01", "2024-07-01T10:00:00Z", "7", None,
     [("MK01", "2024-07-01T10:00:00Z", "POSTED", 7)]),
    (NY, "MK01", "2024-03-10 02:30:00", "7", None,
     [("MK01", "2024-03-10T03:00:00-04:00", "POSTED", 7)]),
    (NY, "MK01", "2024-11-03 01:30:00", "7", None,
     [("MK01", "2024-11-03T01:30:00-04:00", "POSTED", 7)]),
    (TOKYO, "TD01", "2024-01-05", "7", None,
     [("TD01", "2024-01-05T00:00:00+09:00", "POSTED", 7)]),
    (NY, "UH01", "2024-01-05 09:00:00", "7", None,
     [("UH01", "2024-01-05T09:00:00-05:00", "POSTED", 7)]),
    (NY, "MK01", "not a time", "7", None, [("MK01", "not a time", "POSTED", 7)]),
    (NY, "NA", "2024-07-01 10:00:00", "7", None, []),
    (NY, "MK01", "01-05-2024", "7", None, [("MK01", "01-05-2024", "POSTED", 7)]),
    (NY, "  ", "2024-07-01 10:00:00", " 7\t", None,
     [("", "2024-07-01T10:00:00-04:00", "POSTED", 7)]),
    (NY, "　mk02\t", "2024-07-01 10:00:00.75", None, "+12",
     [("MK02", "2024-07-01T10:00:00-04:00", "ACTUAL", 12)]),
]


@pytest.mark.parametrize("zone", [NY, LA, TOKYO])
def test_standby_rows(spark, zone):
    cases = [c for c in CASES if c[0] == zone]
    raw = spark.createDataFrame([c[1:5] for c in cases], RAW)
    got = [tuple(r) for r in normalize_standby(raw, zone).collect()]
    assert sorted(got) == sorted(row for c in cases for row in c[5])


TIMES = [
    ("2024-07-01T10:00", "2024-07-01T10:00:00-04:00"),
    ("2024-7-1 9:05:07", "2024-07-01T09:05:07-04:00"),
    ("2024/07/01 10:00:00", "2024-07-01T10:00:00-04:00"),
    ("7/1/2024 9:05", "2024-07-01T09:05:00-04:00"),
    ("7/1/2024 9:05:30 PM", "2024-07-01T21:05:30-04:00"),
    ("7/1/2024 12:05 AM", "2024-07-01T00:05:00-04:00"),
    ("7-1-2024 10:00", "2024-07-01T10:00:00-04:00"),
    ("20240701", "2024-07-01T00:00:00-04:00"),
    ("20240701 10:00:00", "2024-07-01T10:00:00-04:00"),
    ("13/25/2024 10:00", "13/25/2024 10:00"),
    ("2024-02-30 10:00:00", "2024-02-30 10:00:00"),
    ("1492-10-12 10:00:00", "1492-10-12 10:00:00"),
    ("2024-07-01 10:00:00-05", "2024-07-01 10:00:00-05"),
    ("2024-07-01 10:00:00 America/New_York", "2024-07-01 10:00:00 America/New_York"),
    ("2024-07-01 10:00:00+0000", "2024-07-01 10:00:00+0000"),
    ("2024-07-01 10:00:00z", "2024-07-01 10:00:00z"),
    ("2024-03-10 01:59:59", "2024-03-10T01:59:59-05:00"),
    ("2024-03-10 02:00:00", "2024-03-10T03:00:00-04:00"),
    ("2024-03-10 02:59:59", "2024-03-10T03:00:00-04:00"),
    ("2024-03-10 03:00:00", "2024-03-10T03:00:00-04:00"),
    ("2024-11-03 00:59:59", "2024-11-03T00:59:59-04:00"),
    ("2024-11-03 02:00:00", "2024-11-03T02:00:00-05:00"),
]


def test_offset_text(spark):
    raw = spark.createDataFrame([(t, t) for t, _ in TIMES], "raw string, t string")
    assert [tuple(r) for r in ensure_offset(raw, "t", NY).collect()] == TIMES


def test_filter_on_result_stays_above(spark):
    """A filter on the finished text must not copy its expressions into the scan."""
    raw = spark.createDataFrame([("2024-07-01 10:00:00",)], "t string")
    out = ensure_offset(raw, "t", NY).filter(F.col("t") > "2024")
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert plan[0].startswith("Filter") and sum("to_utc_timestamp" in line for line in plan) == 1
    assert out.count() == 1


@pytest.mark.parametrize(
    "fold,expected",
    [("earlier", "2024-11-03T01:30:00-04:00"), ("later", "2024-11-03T01:30:00-05:00"), ("null", None)],
)
def test_repeated_hour(spark, fold, expected):
    df = spark.createDataFrame([("2024-11-03 01:30:00",), ("2024-11-03 02:30:00",), ("2024-03-10 02:30:00",), ("x",)], "t string")
    got = [r[0] for r in ensure_offset(df, "t", NY, fold=fold).collect()]
    assert got == [expected, "2024-11-03T02:30:00-05:00", "2024-03-10T03:00:00-04:00", "x"]


def test_half_hour_gap_and_zone_column(spark):
    df = spark.createDataFrame(
        [("2024-10-06 02:10:00", "Australia/Lord_Howe"), ("2024-03-10 02:30:00", NY),
         ("2024-07-01 05:00:00", "Asia/Kolkata")],
        "t string, z string",
    )
    got = [r[0] for r in ensure_offset(df, "t", F.col("z")).select("t").collect()]
    assert got == ["2024-10-06T02:30:00+11:00", "2024-03-10T03:00:00-04:00", "2024-07-01T05:00:00+05:30"]


def test_against_zoneinfo(spark):
    """Every half hour of two years in three zones, checked against the tz database."""
    import datetime as dt
    from zoneinfo import ZoneInfo

    base = spark.range(0, 2 * 365 * 48).select(
        (F.expr("timestamp_ntz'2023-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 30).cast("int")))
        .cast("string").alias("raw")
    )
    for zone in (NY, LA, TOKYO):
        tz = ZoneInfo(zone)
        rows = ensure_offset(base.withColumn("t", F.col("raw")), "t", zone).collect()
        for raw, got in rows:
            wall = dt.datetime.fromisoformat(raw)
            aware = wall.replace(tzinfo=tz)
            back = aware.astimezone(dt.timezone.utc).astimezone(tz)
            if back.replace(tzinfo=None) != wall:
                back = back.replace(minute=0, second=0)
                aware = back
            assert got == aware.isoformat(), (zone, raw)
