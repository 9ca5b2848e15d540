"""Schemas and fixed values shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- the table -------------------------------------------------------------
# Column names and the three observation kinds.
KEYS = ["entity_code", "observed_at", "wait_time_type", "wait_time_minutes"]
POSTED = "POSTED"
ACTUAL = "ACTUAL"
PRIORITY = "PRIORITY"

FACT_SCHEMA = T.StructType(
    [
        T.StructField("entity_code", T.StringType()),
        T.StructField("observed_at", T.StringType()),
        T.StructField("wait_time_type", T.StringType()),
        T.StructField("wait_time_minutes", T.LongType()),
    ]
)

# ---- the drops -------------------------------------------------------------
# Property codes, path markers and CSV column names.
PROPERTIES = ["wdw", "dlr", "uor", "ush", "tdr"]
STANDBY = "standby"
PRIORITY_FAMILY = "priority"
FAMILY_MARKERS = {STANDBY: "wait_times", PRIORITY_FAMILY: "fastpass_times"}

STANDBY_COLUMNS = [
    "entity_code",
    "observed_at",
    "submitted_posted_time",
    "submitted_actual_time",
]
STANDBY_REQUIRED = {"entity_code", "observed_at"}
PRIORITY_COLUMNS = [
    "FATTID",
    "FDAY",
    "FMONTH",
    "FYEAR",
    "FHOUR",
    "FMIN",
    "FWINHR",
    "FWINMIN",
]
PRIORITY_REQUIRED = {"FATTID", "FDAY", "FMONTH", "FYEAR", "FHOUR", "FWINHR"}

# Property -> zone; every other property uses DEFAULT_ZONE.
ZONES = {"dlr": "America/Los_Angeles", "tdr": "Asia/Tokyo"}
DEFAULT_ZONE = "America/New_York"

# Texts a CSV field may hold that mean "missing".
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Limits and sentinels.
MAX_MINUTES = 1000
SELLOUT_RAW_HOUR = 8000
SELLOUT_MINUTES = 8888
ROLLOVER_BELOW = -15
SAMPLE_K = 1000
SAMPLE_SEED = 1234
DAYS_BACK = 31
STALE_HOURS = 24
VERY_STALE_HOURS = 48
TOP_NEEDS = 10
HEAD_ROWS = 5
# First read of a header probe; it goes on while the header does.
PROBE_BYTES = 8192
REPORT_ZONE = "America/Toronto"
# Whole years on either side of 1970 that a 64-bit nanosecond clock can hold.
CLOCK_YEARS = 291

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
    ]
)
NEEDS_COLUMNS = ["s3_key", "last_modified_utc", "last_modified_local", "size_bytes"]
LATEST_COLUMNS = ["entity_code", "latest_observation_date"]
