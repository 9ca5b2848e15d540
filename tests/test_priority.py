"""Priority rows: compact clocks, rollover, sell-out, impossible dates."""

import pytest

from obsledger.operators.priority import finish_priority, parse_priority

RAW = ", ".join(
    f"{c} string"
    for c in ["FATTID", "FDAY", "FMONTH", "FYEAR", "FHOUR", "FMIN", "FWINHR", "FWINMIN"]
)
DATE = ("1", "7", "2024")


def run(spark, rows, **rules):
    raw = spark.createDataFrame(rows, RAW)
    out = finish_priority(parse_priority(raw, **rules), "America/New_York")
    return sorted(tuple(r) for r in out.collect())


CASES = [
    (("10", "15", "11", "0"), "10:15", 45, 45),
    (("2318", "99", "0", "10"), "23:18", 52, 52),
    (("231801", None, "2330", None), "23:18", 12, 12),
    (("10", "15", "10", "0"), "10:15", -15, -15),
    (("10", "15", "9", "59"), "10:15", 1424, 1424),
    (("10", "15", "8888", "0"), "10:15", 8888, 824),
    (("10", "15", "8000", "0"), "10:15", 8888, 765),
    (("10", "15", "101500", None), "10:15", 0, 0),
    (("10", "15", "888800", None), "10:15", 8888, 824),
    (("24", "75", "23", "59"), "23:59", 0, 0),
    (("abc", "5", "1", "0"), "00:05", 55, 55),
    (("10.0", " 15 ", "11.0", "0.0"), "10:15", 45, 45),
    (("10.5", "15", "11", "0"), "00:15", 645, 645),
    (("1030.5", "15", "11", "0"), "10:15", 45, 45),
    ((None, None, None, None), "00:00", 0, 0),
    (("-3", "-4", "1", "0"), "00:00", 60, 60),
    (("1d", "5", "1", "0"), "00:05", 55, 55),
]


@pytest.mark.parametrize("sellout,column", [("documented", 2), ("legacy", 3)])
def test_minutes(spark, sellout, column):
    rows = [(f" mk{i:02} ", *DATE, *case[0]) for i, case in enumerate(CASES)]
    assert run(spark, rows, sellout=sellout) == [
        (f"MK{i:02}", f"2024-07-01T{case[1]}:00-04:00", "PRIORITY", case[column])
        for i, case in enumerate(CASES)
    ]


UNREADABLE = [
    (("30", "2", "2024"), "MK01"),
    (("1", "7", None), "MK01"),
    (("1", "7", "19"), "MK01"),
    (("1", "13", "2024"), "MK01"),
    (("0", "7", "2024"), "MK01"),
    (("1.5", "7", "2024"), "MK01"),
    (("1", "7", "99999999999"), "MK01"),
    (("1", "7", "2024x"), "MK01"),
    (DATE, None),
    (DATE, "NaN"),
]


def test_unreadable_rows_are_dropped_alone(spark):
    bad = [(entity, *date, "10", "0", "11", "0") for date, entity in UNREADABLE]
    good = ("MK02", "1.0", "7", "2024", "10", "0", "11", "0")
    assert run(spark, [*bad, good]) == [("MK02", "2024-07-01T10:00:00-04:00", "PRIORITY", 60)]


def test_minutes_stay_in_range(spark):
    """Every observed and returned quarter hour, against plain Python."""
    rows = [
        ("A", *DATE, str(h), str(m), str(r), str(q))
        for h in range(24) for m in (0, 15, 59) for r in range(24) for q in (0, 1, 44, 45)
    ]
    got = parse_priority(spark.createDataFrame(rows, RAW)).collect()
    assert len(got) == len(rows)
    for raw, row in zip(rows, got):
        diff = int(raw[6]) * 60 + int(raw[7]) - int(raw[4]) * 60 - int(raw[5])
        expected = diff + 1440 if diff < -15 else diff
        assert row.wait_time_minutes == expected and -15 <= expected <= 1439
