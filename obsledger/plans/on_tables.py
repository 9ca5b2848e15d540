"""Every operator on the star-schema tables, each with its SQL counterpart.

The tables hold no park data, so a query maps the columns it needs onto an
operator's inputs and then calls the operator itself. All of them read whole
tables. ``QUERIES`` maps a name to the function, ``SQL`` to the statement that
must give the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.functions.numeric import (
    coerce_double,
    half_even,
    in_range,
    split_clock,
)
from obsledger.functions.text import (
    WHITESPACE,
    family_of,
    has_offset,
    null_if_na,
    property_of,
    strip,
)
from obsledger.functions.timestamps import (
    ensure_offset,
    infer_second,
    instant_in_utc,
    is_possible_date,
    iso_seconds,
    iso_utc,
    local_text,
    local_timestamp,
    localize,
)
from obsledger.operators.day_order import day_orders
from obsledger.operators.dedupe import distinct_rows, keep_last
from obsledger.operators.explore import (
    entities_between,
    entity_count,
    entity_rows,
    latest_per_entity,
    newest_rows,
    repeated_keys,
    row_count,
    rows_by_year,
    table_profile,
)
from obsledger.operators.freshness import distinct_days, staleness, top_needs
from obsledger.operators.merge import anti_join, measure, merge
from obsledger.operators.priority import (
    LEGACY,
    add_wait_minutes,
    collapse_priority,
    finish_priority,
    parse_priority,
)
from obsledger.operators.quality import quality
from obsledger.operators.sampling import uniform_sample
from obsledger.operators.standby import normalize_standby, unpivot_waits
from obsledger.plans.build import build, bytes_of
from obsledger.plans.daily import run_daily
from obsledger.plans.latest import latest
from obsledger.plans.observe import Rules
from obsledger.plans.report import freshness, needs_processing
from obsledger.plans.summaries import ENTITIES_BY_DAY, LATEST, sample_summary, summarize
from obsledger.plans.update import update_from
from obsledger.schema import KEYS, PRIORITY_COLUMNS, PROPERTIES
from obsledger.session import new_run_id, table_session, work_dir
from obsledger.sinks.publish import UPDATE, adopt, publish, restore, write_facts
from obsledger.sinks.reports import write_needs
from obsledger.sources.drops import FILE, FILE_ORDER
from obsledger.sources.manifest import (
    newest_first,
    recent,
    scan_drops,
    scan_objects,
    timestamp_literal,
    with_zone,
    zone_dimension,
)
from obsledger.sources.needs import RUN_PREFIX, named_files, newest_needs, read_needs
from obsledger.sources.table import FactTable
from obsledger.streaming.drops import stream_rewrites, stream_updates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

RUN_TS = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
NEW_YORK = "America/New_York"


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sized(spark: SparkSession, sf_dir: str, *names: str) -> SparkSession:
    """A session for aggregates over whole tables; see ``table_session``."""
    files = scan_objects(spark, [f"{sf_dir}/{name}.parquet" for name in names], csv_only=False)
    return table_session(spark, bytes_of(files))


def text_of(c: Column) -> Column:
    return c.cast("string")


def bigint(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


# ---- projections, filters, predicates --------------------------------------
EVENT_FACTS = """
    SELECT 'U' || user_id AS entity_code, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS observed_at,
           upper(event_type) AS wait_time_type, CAST(round_even(value, 0) AS BIGINT) AS wait_time_minutes
    FROM events"""


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), "user_id").alias("entity_code"),
        iso_seconds(F.col("ts")).alias("observed_at"),
        F.upper("event_type").alias("wait_time_type"),
        half_even(F.col("value")).cast("bigint").alias("wait_time_minutes"),
    )


@query(EVENT_FACTS)
def fact_projection(spark, sf_dir):
    return event_facts(spark, sf_dir)


@query("""
    WITH w AS (SELECT 'P' || l_partkey AS entity_code, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS observed_at,
                      round_even(l_quantity, 0) AS p, round_even(l_extendedprice / 100, 0) AS a FROM lineitem),
    u AS (SELECT entity_code, observed_at, 'POSTED' AS wait_time_type, p AS m FROM w
          UNION ALL SELECT entity_code, observed_at, 'ACTUAL', a FROM w)
    SELECT entity_code, observed_at, wait_time_type, CAST(m AS BIGINT) AS wait_time_minutes
    FROM u WHERE m BETWEEN 0 AND 1000""")
def unpivot_waits_lineitem(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("entity_code"),
        iso_seconds(F.col("l_shipdate")).alias("observed_at"),
        half_even(F.col("l_quantity")).alias("posted"),
        half_even(F.col("l_extendedprice") / 100).alias("actual"),
    )
    long = unpivot_waits(df, ["entity_code", "observed_at"], "posted", "actual")
    return long.filter(in_range(F.col("wait_time_minutes"))).select(
        *KEYS[:3], bigint("wait_time_minutes")
    )


@query("""
    SELECT o_orderkey, CAST(round_even(o_totalprice / 200, 0) AS BIGINT) AS wait_time_minutes
    FROM orders WHERE round_even(o_totalprice / 200, 0) BETWEEN 0 AND 1000""")
def range_filter(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", half_even(F.col("o_totalprice") / 200).alias("wait_time_minutes")
    )
    return df.filter(in_range(F.col("wait_time_minutes"))).select(
        "o_orderkey", bigint("wait_time_minutes")
    )


@query("""
    WITH r AS (SELECT o_orderkey, CASE o_orderkey % 6
                   WHEN 0 THEN substr(o_orderpriority, 1, 1) WHEN 1 THEN substr(o_orderpriority, 1, 2)
                   WHEN 2 THEN ' +' || o_custkey || '.5 ' WHEN 3 THEN o_custkey || 'd'
                   WHEN 4 THEN 'Infinity' ELSE o_custkey || 'e-2' END AS raw FROM orders)
    SELECT o_orderkey, CAST(trim(raw) AS DOUBLE) AS number FROM r
    WHERE regexp_full_match(trim(raw), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')""")
def coerce_numeric(spark, sf_dir):
    kind, key = F.col("o_orderkey") % 6, text_of(F.col("o_custkey"))
    raw = (
        F.when(kind == 0, F.substring("o_orderpriority", 1, 1))
        .when(kind == 1, F.substring("o_orderpriority", 1, 2))
        .when(kind == 2, F.concat(F.lit(" +"), key, F.lit(".5 ")))
        .when(kind == 3, F.concat(key, F.lit("d")))
        .when(kind == 4, F.lit("Infinity"))
        .otherwise(F.concat(key, F.lit("e-2")))
    )
    df = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return df.select("o_orderkey", coerce_double(F.col("raw")).alias("number")).na.drop(
        subset=["number"]
    )


@query("""
    SELECT CASE WHEN event_type <> 'error' THEN event_type END AS event_type, count(*) AS n
    FROM events GROUP BY 1""")
def na_tokens(spark, sf_dir):
    raw = F.when(F.col("event_type") == "error", "NA").otherwise(F.col("event_type"))
    df = table(spark, sf_dir, "events").select(raw.alias("event_type"))
    return (
        df.select(null_if_na(F.col("event_type")).alias("event_type"))
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )


SUFFIXES = ["", "Z", "+00:00", "-0500", "-05"]


@query("""
    SELECT o_orderkey, (o_orderkey % 5) IN (1, 2, 3) AS has_offset FROM orders""")
def has_offset_orders(spark, sf_dir):
    suffix = F.element_at(
        F.array(*[F.lit(s) for s in SUFFIXES]), (F.col("o_orderkey") % 5 + 1).cast("int")
    )
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(iso_seconds(F.col("o_orderdate")), suffix).alias("t")
    )
    return df.select("o_orderkey", has_offset(F.col("t")).alias("has_offset"))


_CHARS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


@query(f"""
    SELECT doc_id, lang, CAST(length(trim(text, {_CHARS})) AS BIGINT) AS stripped_chars
    FROM documents""")
def strip_text(spark, sf_dir):
    padded = F.concat(F.lit("\t  "), "lang", F.lit(" \u3000\r\n"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        strip(padded).alias("lang"),
        F.length(strip(F.col("text"))).cast("bigint").alias("stripped_chars"),
    )


@query("""
    SELECT page_id, lower(regexp_extract(url, '//[^/]+/([^/?#]+)', 1)) AS segment FROM pages""")
def path_property(spark, sf_dir):
    # The first path segment of a URL takes the place of the property.
    path = F.regexp_replace("url", r"^[a-zA-Z]+://[^/]+/([^/?#]+).*$", "/wait_times/$1/x")
    return table(spark, sf_dir, "pages").select("page_id", property_of(path).alias("segment"))


@query("""
    WITH f AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'standby' WHEN 'de' THEN 'priority' END AS family
               FROM documents)
    SELECT doc_id, coalesce(family, 'unknown') AS family FROM f""")
def route_family(spark, sf_dir):
    folder = (
        F.when(F.col("lang") == "en", "wait_times")
        .when(F.col("lang") == "de", "fastpass_times")
        .otherwise("other")
    )
    path = F.concat(F.lit("s3a://bucket/export/"), folder, F.lit("/wdw/"), "source", F.lit(".csv"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(family_of(path), F.lit("unknown")).alias("family")
    )


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'click'")
def entity_filter(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return entity_rows(df, "click", "event_type").select("event_id", "user_id", "value")


# ---- time --------------------------------------------------------------------
_OFFSET_SQL = """CASE WHEN off < 0 THEN '-' ELSE '+' END
    || lpad(CAST(abs(off) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(abs(off) % 60 AS VARCHAR), 2, '0')"""


@query(f"""
    WITH a AS (SELECT o_orderkey, o_orderdate + to_hours(CAST(4 + o_orderkey % 18 AS INTEGER)) AS l,
                      CASE o_custkey % 3 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Los_Angeles'
                           ELSE 'Asia/Tokyo' END AS zone FROM orders),
    b AS (SELECT *, date_diff('minute', timezone('UTC', timezone(zone, l)), l) AS off FROM a)
    SELECT o_orderkey, zone, strftime(l, '%Y-%m-%dT%H:%M:%S') || {_OFFSET_SQL} AS observed_at FROM b""")
def localize_offset(spark, sf_dir):
    prop = F.when(F.col("o_custkey") % 3 == 0, "wdw").when(
        F.col("o_custkey") % 3 == 1, "dlr"
    ).otherwise("tdr")
    hours = F.make_dt_interval(F.lit(0), (4 + F.col("o_orderkey") % 18).cast("int"))
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", prop.alias("prop"), (F.col("o_orderdate") + hours).alias("l")
    )
    df = with_zone(df, zone_dimension(spark))
    return localize(df, "l", F.col("zone"), "observed_at").select(
        "o_orderkey", "zone", "observed_at"
    )


@query(f"""
    WITH a AS (SELECT o_orderkey, o_orderkey % 6 AS kind, o_orderdate + to_hours(9) AS l FROM orders),
    b AS (SELECT *, date_diff('minute', timezone('UTC', timezone('America/Los_Angeles', l)), l) AS off FROM a)
    SELECT o_orderkey, CASE kind WHEN 4 THEN strftime(l, '%Y-%m-%d %H:%M:%S') || 'Z'
                                 WHEN 5 THEN 'on ' || strftime(l, '%Y-%m-%d')
                                 ELSE strftime(l, '%Y-%m-%dT%H:%M:%S') || {_OFFSET_SQL} END AS observed_at FROM b""")
def ensure_offset_orders(spark, sf_dir):
    day = text_of(F.to_date("o_orderdate"))
    month_day_year = F.concat(
        F.substring(day, 6, 2), F.lit("/"), F.substring(day, 9, 2), F.lit("/"), F.substring(day, 1, 4)
    )
    forms = [
        F.concat(day, F.lit(" 09:00:00")),
        F.concat(day, F.lit("T9:00")),
        F.concat(month_day_year, F.lit(" 9:00 AM")),
        F.concat(F.replace(day, F.lit("-"), F.lit("")), F.lit(" 09:00")),
        F.concat(day, F.lit(" 09:00:00Z")),
        F.concat(F.lit("on "), day),
    ]
    raw = F.element_at(F.array(*forms), (F.col("o_orderkey") % 6 + 1).cast("int"))
    df = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("observed_at"))
    return ensure_offset(df, "observed_at", "America/Los_Angeles")


@query("""
    WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, (l_orderkey * 17) % 240000 AS v FROM lineitem)
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CAST(CASE WHEN v >= 10000 THEN v // 10000 WHEN v >= 100 THEN v // 100 ELSE v END AS BIGINT) AS hour,
           CAST(CASE WHEN v >= 10000 THEN (v % 10000) // 100 WHEN v >= 100 THEN v % 100
                ELSE l_partkey % 60 END AS BIGINT) AS minute FROM v""")
def compact_time(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        bigint("l_linenumber"),
        ((F.col("l_orderkey") * 17) % 240000).cast("double").alias("v"),
        (F.col("l_partkey") % 60).alias("m"),
    )
    return split_clock(df, "v", F.col("m"), "hour", "minute").drop("v", "m")


@query("""
    SELECT o_orderkey, strftime(try_cast(printf('%04d-%02d-%02d', 2024, 1 + o_orderkey % 12, 1 + o_orderkey % 31)
                                AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') AS at FROM orders""")
def safe_timestamp(spark, sf_dir):
    year, key = F.lit(2024), F.col("o_orderkey")
    at = local_timestamp(year, 1 + key % 12, 1 + key % 31, F.lit(0), F.lit(0))
    possible = is_possible_date(year, 1 + key % 12, 1 + key % 31)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(possible, iso_seconds(at)).alias("at")
    )


@query("""
    WITH a AS (SELECT o_orderkey, timezone('America/Toronto', timezone('UTC', o_orderdate)) AS l, o_orderdate AS u
               FROM orders),
    b AS (SELECT *, date_diff('minute', u, l) AS off FROM a)
    SELECT o_orderkey, strftime(u, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS utc_text,
           strftime(l, '%Y-%m-%d %H:%M:%S') || CASE off WHEN -240 THEN ' EDT (UTC-04:00)'
                                                    ELSE ' EST (UTC-05:00)' END AS local_text FROM b""")
def report_times(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", instant_in_utc(F.col("o_orderdate")).alias("at")
    )
    return df.select(
        "o_orderkey",
        iso_utc(F.col("at")).alias("utc_text"),
        local_text(F.col("at"), "America/Toronto").alias("local_text"),
    )


# ---- priority ------------------------------------------------------------------
_CLOCK_SQL = """
    WITH r AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
                      (l_orderkey % 24) * 100 + l_partkey % 60 AS oh, l_suppkey % 24 AS rh, (l_linenumber * 8) % 60 AS rm,
                      l_linenumber = 7 AS sold FROM lineitem),
    m AS (SELECT *, CASE WHEN oh >= 100 THEN (oh // 100) * 60 + oh % 100 ELSE least(oh, 23) * 60 END AS om FROM r)"""
_KEY_SQL = "l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber"


def _priority_inputs(spark, sf_dir, sold_out: bool) -> DataFrame:
    hour = (F.col("l_suppkey") % 24).cast("double")
    if sold_out:
        hour = F.when(F.col("l_linenumber") == 7, 8888.0).otherwise(hour)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        bigint("l_linenumber"),
        ((F.col("l_orderkey") % 24) * 100 + F.col("l_partkey") % 60).cast("double").alias("oh"),
        hour.alias("rh"),
        ((F.col("l_linenumber") * 8) % 60).alias("rm"),
    )


def _priority_minutes(spark, sf_dir, sold_out: bool, **rules) -> DataFrame:
    df = add_wait_minutes(
        _priority_inputs(spark, sf_dir, sold_out),
        "wait_time_minutes",
        observed=("oh", F.lit(None).cast("bigint")),
        returned=("rh", F.col("rm")),
        **rules,
    )
    return df.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "wait_time_minutes"
    )


@query(f"""{_CLOCK_SQL}, d AS (SELECT *, rh * 60 + rm - om AS d FROM m)
    SELECT {_KEY_SQL}, CAST(CASE WHEN d < -15 THEN d + 1440 ELSE d END AS BIGINT) AS wait_time_minutes FROM d""")
def priority_minutes(spark, sf_dir):
    return _priority_minutes(spark, sf_dir, False)


@query(f"""{_CLOCK_SQL}, d AS (SELECT *, rh * 60 + rm - om AS d FROM m)
    SELECT {_KEY_SQL}, CAST(CASE WHEN sold THEN 8888 WHEN d < -15 THEN d + 1440 ELSE d END AS BIGINT)
           AS wait_time_minutes FROM d""")
def priority_sellout(spark, sf_dir):
    return _priority_minutes(spark, sf_dir, True)


_BOUNDS = (7999, 8000, 9999, 101500, 888800)


@query(f"""
    WITH r AS (SELECT *, (l_orderkey % 24) * 60 + l_partkey % 60 AS om,
               CASE l_suppkey % 5 WHEN 0 THEN 7999 WHEN 1 THEN 8000 WHEN 2 THEN 9999 WHEN 3 THEN 101500 ELSE 888800 END AS raw
               FROM lineitem),
    d AS (SELECT *, CASE WHEN raw = 101500 THEN 615 ELSE 23 * 60 + 59 END - om AS d FROM r)
    SELECT {_KEY_SQL}, CAST(raw AS BIGINT) AS raw, CAST(CASE WHEN raw IN (8000, 9999, 888800) THEN 8888
           WHEN d < -15 THEN d + 1440 ELSE d END AS BIGINT) AS wait_time_minutes FROM d""")
def sellout_bounds(spark, sf_dir):
    """Raw return hours around the sold-out mark."""
    raw = F.element_at(F.array(*[F.lit(float(b)) for b in _BOUNDS]), (F.col("l_suppkey") % 5 + 1).cast("int"))
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        bigint("l_linenumber"),
        (F.col("l_orderkey") % 24).cast("double").alias("oh"),
        (F.col("l_partkey") % 60).alias("om"),
        raw.alias("raw"),
    )
    df = add_wait_minutes(
        df, "wait_time_minutes", observed=("oh", F.col("om")), returned=("raw", F.lit(None).cast("bigint"))
    )
    return df.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", bigint("raw"), "wait_time_minutes"
    )


@query(f"""{_CLOCK_SQL}, d AS (SELECT *, CASE WHEN sold THEN 1439 ELSE rh * 60 + rm END - om AS d FROM m)
    SELECT {_KEY_SQL}, CAST(CASE WHEN d < -15 THEN d + 1440 ELSE d END AS BIGINT) AS wait_time_minutes FROM d""")
def priority_sellout_legacy(spark, sf_dir):
    return _priority_minutes(spark, sf_dir, True, sellout=LEGACY)


# ---- composite normalisers -------------------------------------------------------
STANDBY_SQL = f"""
    SELECT 'U' || user_id AS entity_code, CAST(round_even(value, 0) AS BIGINT) AS posted,
           CAST(round_even(value / 2, 0) AS BIGINT) AS actual,
           strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-05:00' AS observed_at FROM events"""
_STANDBY_ROWS_SQL = f"""
    SELECT entity_code, observed_at, 'POSTED' AS wait_time_type, posted AS wait_time_minutes
    FROM ({STANDBY_SQL}) WHERE posted BETWEEN 0 AND 1000
    UNION ALL SELECT entity_code, observed_at, 'ACTUAL', actual FROM ({STANDBY_SQL})
    WHERE actual BETWEEN 0 AND 1000"""


def standby_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw standby rows: texts as a CSV would hold them."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), "user_id").alias("entity_code"),
        text_of(F.col("ts")).alias("observed_at"),
        text_of(F.col("value")).alias("submitted_posted_time"),
        text_of(F.col("value") / 2).alias("submitted_actual_time"),
    )


@query(_STANDBY_ROWS_SQL)
def standby_observations(spark, sf_dir):
    return normalize_standby(standby_raw(spark, sf_dir), NEW_YORK)


_PRIORITY_ROWS_SQL = f"""
    WITH r AS (SELECT 'L' || l_orderkey AS entity_code,
                      l_shipdate + to_hours(CAST(9 + l_linenumber AS INTEGER)) AS l, l_suppkey % 24 AS rh,
                      (l_partkey % 60) AS rm, (9 + l_linenumber) * 60 AS om,
                      (l_partkey * 1000000 + l_suppkey) * 100 + l_quantity AS ord FROM lineitem),
    d AS (SELECT *, rh * 60 + rm - om AS d FROM r),
    k AS (SELECT entity_code, l, arg_max(CASE WHEN d < -15 THEN d + 1440 ELSE d END, ord) AS m
          FROM d GROUP BY entity_code, l),
    b AS (SELECT *, date_diff('minute', timezone('UTC', timezone('America/New_York', l)), l) AS off FROM k)
    SELECT entity_code, strftime(l, '%Y-%m-%dT%H:%M:%S') || {_OFFSET_SQL} AS observed_at,
           'PRIORITY' AS wait_time_type, CAST(m AS BIGINT) AS wait_time_minutes FROM b"""


def line_order() -> Column:
    """Stands for the position of a row in its file; equal only for equal values."""
    return (
        (F.col("l_partkey") * 1000000 + F.col("l_suppkey")) * 100 + F.col("l_quantity")
    ).cast("bigint")


def priority_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw priority rows of one file."""
    day = text_of(F.to_date("l_shipdate"))
    return table(spark, sf_dir, "lineitem").select(
        F.lit("one.csv").alias(FILE),
        line_order().alias(FILE_ORDER),
        F.concat(F.lit("l"), "l_orderkey").alias("FATTID"),
        F.substring(day, 9, 2).alias("FDAY"),
        F.substring(day, 6, 2).alias("FMONTH"),
        F.substring(day, 1, 4).alias("FYEAR"),
        text_of((9 + F.col("l_linenumber")) * 100).alias("FHOUR"),
        F.lit(None).cast("string").alias("FMIN"),
        text_of(F.col("l_suppkey") % 24).alias("FWINHR"),
        text_of(F.col("l_partkey") % 60).alias("FWINMIN"),
    )


def priority_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_priority(priority_raw(spark, sf_dir))
    return finish_priority(collapse_priority(parsed), NEW_YORK)


@query(_PRIORITY_ROWS_SQL)
def priority_observations(spark, sf_dir):
    return priority_facts(sized(spark, sf_dir, "lineitem"), sf_dir)


def all_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both families, distinct: the table a full build would publish."""
    spark = sized(spark, sf_dir, "events", "lineitem")
    standby = normalize_standby(standby_raw(spark, sf_dir), NEW_YORK)
    return distinct_rows(standby.unionByName(priority_facts(spark, sf_dir)))


_ALL_FACTS_SQL = f"""SELECT DISTINCT * FROM ({_STANDBY_ROWS_SQL} UNION ALL SELECT * FROM ({_PRIORITY_ROWS_SQL}))"""


@query(_ALL_FACTS_SQL)
def full_table(spark, sf_dir):
    return all_facts(spark, sf_dir)


@query(f"""
    SELECT entity_code, max(substr(observed_at, 1, 10)) AS latest_observation_date
    FROM ({_ALL_FACTS_SQL}) GROUP BY 1""")
def latest_of_full_table(spark, sf_dir):
    return latest_per_entity(all_facts(spark, sf_dir))


@query(f"""
    SELECT count(*) AS rows, CAST(0 AS BIGINT) AS no_offset, CAST(0 AS BIGINT) AS blank_entity,
           count(*) FILTER (wait_time_minutes < 0) AS negative_wait, CAST(0 AS BIGINT) AS sold_out
    FROM ({_ALL_FACTS_SQL})""")
def table_quality(spark, sf_dir):
    return quality(all_facts(spark, sf_dir))


# ---- distinct, keep-last, joins, merge ---------------------------------------------
@query("""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CAST(arg_max(l_quantity, (l_partkey * 1000000 + l_suppkey) * 100 + l_quantity) AS BIGINT) AS quantity,
           count(*) AS source_rows
    FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def collapse_keep_last(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        bigint("l_linenumber"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        line_order().alias("position"),
    )
    return keep_last(df, ["l_orderkey", "l_linenumber"], "quantity", "position")


@query("""
    SELECT DISTINCT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag, l_linestatus
    FROM lineitem""")
def distinct_lines(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", bigint("l_linenumber"), "l_returnflag", "l_linestatus"
    )
    return distinct_rows(df, df.columns)


@query("""
    SELECT DISTINCT l_orderkey, l_partkey FROM lineitem n
    WHERE NOT EXISTS (SELECT 1 FROM lineitem e WHERE e.l_shipdate < TIMESTAMP '1998-01-01'
                      AND e.l_orderkey = n.l_orderkey AND e.l_partkey = n.l_partkey)""")
def new_rows_anti(spark, sf_dir):
    keys = ["l_orderkey", "l_partkey"]
    lines = table(spark, sf_dir, "lineitem")
    existing = lines.filter(F.col("l_shipdate") < F.expr("timestamp_ntz'1998-01-01 00:00:00'"))
    return anti_join(distinct_rows(lines, keys), existing, keys=keys)


@query(f"""
    WITH f AS ({EVENT_FACTS}), e AS (SELECT * FROM f WHERE observed_at < '2024-01-20')
    SELECT * FROM e UNION ALL
    (SELECT DISTINCT * FROM f EXCEPT SELECT * FROM e)""")
def merge_fact(spark, sf_dir):
    facts = event_facts(spark, sf_dir)
    return merge(facts.filter(F.col("observed_at") < "2024-01-20"), facts)


# ---- reports -----------------------------------------------------------------------
@query("""
    SELECT 'U' || user_id AS entity_code, max(strftime(ts, '%Y-%m-%d')) AS latest_observation_date
    FROM events GROUP BY 1""")
def latest_by_entity(spark, sf_dir):
    return latest_per_entity(event_facts(spark, sf_dir))


@query("SELECT count(DISTINCT user_id) AS entities FROM events")
def entity_count_events(spark, sf_dir):
    return entity_count(table(spark, sf_dir, "events"), "user_id")


@query("""
    SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS count FROM orders GROUP BY 1""")
def rows_by_year_orders(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(iso_seconds(F.col("o_orderdate")).alias("observed_at"))
    return rows_by_year(df).select(bigint("year"), "count")


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS observed_at FROM events
    ORDER BY 2 DESC, event_id LIMIT 5""")
def newest_rows_events(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(
        "event_id", iso_seconds(F.col("ts")).alias("observed_at")
    )
    return newest_rows(df, ties=["event_id"])


@query("SELECT count(*) AS rows FROM lineitem")
def row_count_lineitem(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"))


@query("""
    SELECT count(*) AS rows, count(event_id) AS non_null_event_id, count(ts) AS non_null_ts,
           count(user_id) AS non_null_user_id, count(event_type) AS non_null_event_type,
           count(value) AS non_null_value, count(props) AS non_null_props FROM events""")
def table_profile_events(spark, sf_dir):
    return table_profile(table(spark, sf_dir, "events"))


@query("""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def repeated_line_keys(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", bigint("l_linenumber"))
    return repeated_keys(df, ["l_orderkey", "l_linenumber"])


@query("""
    SELECT event_id, user_id FROM events
    ORDER BY md5(event_id || '|1234'), event_id LIMIT 1000""")
def uniform_sample_events(spark, sf_dir):
    # The default rank is a 64-bit hash; MD5 stands in for it where SQL must follow.
    df = table(spark, sf_dir, "events").select("event_id", "user_id")
    rank = F.md5(F.concat(text_of(F.col("event_id")), F.lit("|1234")))
    return uniform_sample(df, 1000, rank=rank)


# ---- manifest: events stand for files, their times for modification times -------------
_MANIFEST_SQL = """
    SELECT event_id, date_trunc('second', ts) AS m,
           CASE event_type WHEN 'click' THEN 'current_' WHEN 'error' THEN 'current_test_' ELSE 'day_' END
           || event_id || '.csv' AS path FROM events"""
_MARK_SQL = "(SELECT max(date_trunc('second', ts)) FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-20')"


def event_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (
        F.when(F.col("event_type") == "click", "current_")
        .when(F.col("event_type") == "error", "current_test_")
        .otherwise("day_")
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(kind, text_of(F.col("event_id")), F.lit(".csv")).alias("path"),
        instant_in_utc(F.col("ts")).alias("modificationTime"),
    )


def event_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = F.col("ts") < F.expr("timestamp_ntz'2024-01-20 00:00:00'")
    return (
        table(spark, sf_dir, "events")
        .filter((F.col("event_type") == "signup") & before)
        .agg(instant_in_utc(F.max("ts")).alias("modified"))
    )


def _listed(manifest: DataFrame) -> DataFrame:
    return manifest.select("path", iso_utc(F.col("modificationTime")).alias("modified"))


_LISTED_SQL = "path, strftime(m, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS modified"


@query(f"""
    SELECT 's3://bucket/export/' || path AS path, strftime(m, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS modified
    FROM ({_MANIFEST_SQL}) f WHERE EXISTS (SELECT 1 FROM events e WHERE e.event_id = f.event_id AND e.event_type = 'click')""")
def files_semi(spark, sf_dir):
    """The listed files that a needs list names: keys of users below the root, absolute ones as they are."""
    root = "s3://bucket/export"
    listed = event_manifest(spark, sf_dir)
    files = listed.withColumn("path", F.concat(F.lit(f"{root}/"), "path"))
    relative = F.col("path").startswith("current_") & ~F.col("path").startswith("current_test_")
    absolute = F.col("event_id") % 2 == 0
    keys = listed.filter(relative).select(
        F.when(absolute, F.concat(F.lit(f"{root}/"), "path")).otherwise(F.col("path")).alias("s3_key")
    )
    # A list may name a file twice and name files that are gone.
    twice = keys.unionByName(keys).unionByName(keys.limit(1).select(F.lit("gone.csv").alias("s3_key")))
    return _listed(named_files(files, twice, root))


@query(f"SELECT {_LISTED_SQL} FROM ({_MANIFEST_SQL}) WHERE m >= TIMESTAMP '2024-01-31' - INTERVAL 10 DAY")
def recent_objects(spark, sf_dir):
    files = recent(event_manifest(spark, sf_dir), timestamp_literal(RUN_TS), 10)
    return _listed(newest_first(files))


@query(f"SELECT {_LISTED_SQL} FROM ({_MANIFEST_SQL}) WHERE m > {_MARK_SQL}")
def needs_processing_events(spark, sf_dir):
    return _listed(
        needs_processing(event_manifest(spark, sf_dir), event_watermark(spark, sf_dir), RUN_TS)
    )


@query(f"SELECT {_LISTED_SQL} FROM ({_MANIFEST_SQL}) WHERE m > {_MARK_SQL} ORDER BY m DESC, path LIMIT 10")
def needs_top10(spark, sf_dir):
    needs = needs_processing(
        event_manifest(spark, sf_dir), event_watermark(spark, sf_dir), RUN_TS
    )
    return _listed(top_needs(needs))


@query(f"""
    SELECT path, CASE WHEN path LIKE 'current%' AND path NOT LIKE 'current_test%' THEN
                 CASE WHEN m < TIMESTAMP '2024-01-29' THEN 'VERY_STALE'
                      WHEN m < TIMESTAMP '2024-01-30' THEN 'STALE' END END AS staleness
    FROM ({_MANIFEST_SQL})""")
def staleness_events(spark, sf_dir):
    label = staleness(F.col("path"), F.col("modificationTime"), timestamp_literal(RUN_TS))
    return event_manifest(spark, sf_dir).select("path", label.alias("staleness"))


@query("SELECT count(DISTINCT CAST(ts AS DATE)) AS days FROM events WHERE ts >= TIMESTAMP '2024-01-21'")
def recent_days(spark, sf_dir):
    files = recent(event_manifest(spark, sf_dir), timestamp_literal(RUN_TS), 10)
    return distinct_days(files)


# ---- whole jobs over CSV drops that Spark writes from the tables ------------------------
_DROP_SQL = f"""
    SELECT DISTINCT * FROM (
        SELECT 'U' || user_id AS entity_code,
               strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE user_id % 5 WHEN 1 THEN '-08:00' WHEN 4 THEN '+09:00'
                                                    ELSE '-05:00' END AS observed_at,
               'POSTED' AS wait_time_type, CAST(round_even(value, 0) AS BIGINT) AS wait_time_minutes FROM events
        UNION ALL
        SELECT 'P' || event_id, strftime(ts, '%Y-%m-%dT%H:%M:00') || CASE user_id % 5 WHEN 1 THEN '-08:00'
                                                    WHEN 4 THEN '+09:00' ELSE '-05:00' END, 'PRIORITY',
               CAST(user_id % 60 AS BIGINT) FROM events)"""


def drop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prop = F.element_at(F.array(*map(F.lit, PROPERTIES)), (F.col("user_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "events").withColumn("prop", prop)


def standby_drops(events: DataFrame, *first: str) -> DataFrame:
    return events.select(
        "prop",
        *first,
        F.concat(F.lit("u"), "user_id").alias("entity_code"),
        text_of(F.col("ts")).alias("observed_at"),
        F.col("value").alias("submitted_posted_time"),
    )


def priority_drops(events: DataFrame, *first: str) -> DataFrame:
    offered = F.col("ts") + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("user_id") % 60).cast("int")
    )
    return events.select(
        "prop",
        *first,
        F.hour(offered).alias("FWINHR"),
        F.minute(offered).alias("FWINMIN"),
        F.concat(F.lit("p"), "event_id").alias("FATTID"),
        F.dayofmonth("ts").alias("FDAY"),
        F.month("ts").alias("FMONTH"),
        F.year("ts").alias("FYEAR"),
        F.hour("ts").alias("FHOUR"),
        F.minute("ts").alias("FMIN"),
    )


WRITES_AT_ONCE = 12


def _write_csvs(frames: dict[str, DataFrame], **options) -> None:
    """Each frame to its folder. Several at once, as a frame that becomes one file is one task."""

    def write(folder: str) -> None:
        frames[folder].write.options(header=True, **options).csv(folder)

    with ThreadPoolExecutor(WRITES_AT_ONCE) as pool:
        list(pool.map(write, frames))


def _write_families(root: str, standby: DataFrame, priority: DataFrame, *, files: int | None = None, **options) -> None:
    frames: dict[str, DataFrame] = {}
    for prop in PROPERTIES:
        for folder, df in (("wait_times", standby), ("fastpass_times", priority)):
            mine = df.filter(F.col("prop") == prop).drop("prop")
            frames[f"{root}/{folder}/{prop}"] = mine if files is None else mine.repartition(files)
    _write_csvs(frames, **options)


def write_drops(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Events as CSV drops of all properties in both families, below ``root``."""
    events = drop_events(spark, sf_dir)
    _write_families(root, standby_drops(events), priority_drops(events))


def _run_folder(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/on-tables-{new_run_id()}"


@query(_DROP_SQL)
def build_from_drops(spark, sf_dir):
    """Manifest, header probe, CSV scans, normalisers, distinct, publish, read back."""
    folder = _run_folder(spark)
    write_drops(spark, sf_dir, f"{folder}/export")
    facts = FactTable(f"{folder}/fact")
    build(spark, f"{folder}/export", facts, run_ts=dt.datetime.now(dt.timezone.utc))
    return facts.read(spark)


@query(_DROP_SQL)
def update_from_drops(spark, sf_dir):
    """Build from one property's drops, then merge all drops into that table."""
    folder = _run_folder(spark)
    write_drops(spark, sf_dir, f"{folder}/export")
    facts = FactTable(f"{folder}/fact")
    now = dt.datetime.now(dt.timezone.utc)
    build(spark, f"{folder}/export", facts, run_ts=now, properties=["dlr"])
    update_from(spark, scan_drops(spark, f"{folder}/export"), facts, listed_at=now)
    return facts.read(spark)


# ---- drops of many layouts, runs, versions and reports as files -----------------------
def write_mixed_drops(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The same events in many layouts: mixed-case and padded headers, other orders, no headers.

    Files of different layouts lie in folders of their own, so a name may occur in several.
    """
    events = drop_events(spark, sf_dir)
    half, third = F.pmod(F.xxhash64("entity_code"), F.lit(2)), F.pmod(F.xxhash64("FATTID"), F.lit(3))
    frames: dict[str, DataFrame] = {}
    for prop in PROPERTIES:
        mine = events.filter(F.col("prop") == prop)
        standby, priority = standby_drops(mine).drop("prop"), priority_drops(mine).drop("prop")
        renamed = standby.filter(half == 0).select(
            F.lit("x").alias("note"),
            F.col("submitted_posted_time").alias(" Submitted_POSTED_time"),
            F.col("observed_at").alias("OBSERVED_AT "),
            F.col("entity_code").alias("Entity_Code"),
        )
        turned = priority.select(*[F.col(c).alias(c.lower()) for c in reversed(priority.columns)])
        bare = priority.filter(third == 2).select(*PRIORITY_COLUMNS)
        bare = bare.toDF(*[f"field {i}" for i in range(len(PRIORITY_COLUMNS))])
        for part, frame in (("a", standby.filter(half == 1)), ("b", renamed)):
            frames[f"{root}/export/wait_times/{prop}/{part}"] = frame
        turned = turned.filter(F.pmod(F.xxhash64("fattid"), F.lit(3)) == 1)
        for k, frame in enumerate((priority.filter(third == 0), turned, bare)):
            frames[f"{root}/export/fastpass_times/{prop}/{k}"] = frame
    _write_csvs(frames)


@query(_DROP_SQL)
def build_mixed_layouts(spark, sf_dir):
    folder = _run_folder(spark)
    write_mixed_drops(spark, sf_dir, folder)
    facts = FactTable(f"{folder}/fact")
    build(spark, f"{folder}/export", facts, run_ts=dt.datetime.now(dt.timezone.utc))
    return facts.read(spark)


@query(_DROP_SQL)
def quoted_breaks(spark, sf_dir):
    """Drops whose first column is a note of several lines with quotes and commas in two of three rows."""
    folder = _run_folder(spark)
    events = drop_events(spark, sf_dir)
    note = F.concat(F.lit('said ""no"",\nthen "'), text_of(F.col("event_id")), F.lit('"\n\n, left'))
    note = F.when(F.col("event_id") % 3 > 0, note).otherwise("plain")
    events = events.withColumn("note", note)
    _write_families(f"{folder}/export", standby_drops(events, "note"), priority_drops(events, "note"), escape='"')
    facts = FactTable(f"{folder}/fact")
    build(spark, f"{folder}/export", facts, run_ts=dt.datetime.now(dt.timezone.utc))
    return facts.read(spark)


# ---- drops with rows that cannot be used --------------------------------------------------
_USABLE_SQL = f"""
    SELECT DISTINCT * FROM (
        SELECT 'U' || user_id AS entity_code, ts, 'POSTED' AS kind, round_even(value, 0) AS minutes
        FROM events WHERE event_id % 97 <> 0
        UNION ALL
        SELECT 'P' || event_id, date_trunc('minute', ts), 'PRIORITY', user_id % 60 FROM events WHERE event_id % 89 <> 0)"""


def write_odd_drops(spark: SparkSession, sf_dir: str, root: str) -> None:
    """One standby row in 97 has a field too many, one priority row in 89 no possible month; of one in
    83 an earlier row with another return time stands before it, and one file has no known column."""
    events = drop_events(spark, sf_dir)
    shifted = F.when(F.col("event_id") % 97 == 0, "1,2").otherwise(text_of(F.col("value")))
    standby = standby_drops(events.withColumn("value", shifted))
    twice = F.when(F.col("event_id") % 83 == 0, F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.lit(0)))
    priority = priority_drops(events.withColumn("early", F.explode(twice)), "early", "event_id")
    priority = priority.withColumn(
        "FWINMIN", F.when(F.col("early") == 1, 59 - F.col("FWINMIN")).otherwise(F.col("FWINMIN"))
    ).withColumn("FMONTH", F.when(F.col("event_id") % 89 == 0, 13).otherwise(F.col("FMONTH")))
    _write_families(root, standby, priority, quote="\u0000")
    spark.range(1).coalesce(1).write.option("header", True).csv(f"{root}/wait_times/wdw/unknown")


@query("""
    SELECT 'standby' AS family, 'shifted_rows' AS reason, 'u' || user_id AS entity FROM events WHERE event_id % 97 = 0
    UNION ALL SELECT 'priority', 'undated_rows', 'p' || event_id FROM events WHERE event_id % 89 = 0
    UNION ALL SELECT 'priority', 'undated_rows', 'p' || event_id FROM events WHERE event_id % 89 = 0 AND event_id % 83 = 0""")
def quarantine_rows(spark, sf_dir):
    """The rows that a build left out, as it stored them."""
    folder = _run_folder(spark)
    write_odd_drops(spark, sf_dir, f"{folder}/export")
    facts = FactTable(f"{folder}/fact")
    done = build(spark, f"{folder}/export", facts, run_ts=dt.datetime.now(dt.timezone.utc))
    entity = F.coalesce(F.get_json_object("fields", "$.entity_code"), F.get_json_object("fields", "$.FATTID"))
    return facts.left_out(spark, done.commit.run_id).select("family", "reason", entity.alias("entity"))


@query(f"""
    SELECT 'new_rows' AS metric, count(*) AS value FROM ({_USABLE_SQL})
    UNION ALL SELECT 'collapsed_rows', count(*) FROM events WHERE event_id % 83 = 0 AND event_id % 89 <> 0
    UNION ALL SELECT 'shifted_rows', count(*) FROM events WHERE event_id % 97 = 0
    UNION ALL SELECT 'undated_rows', count(*) + count(*) FILTER (event_id % 83 = 0) FROM events WHERE event_id % 89 = 0
    UNION ALL SELECT 'rejected_files', 1""")
def run_metrics(spark, sf_dir):
    """The counts that a build stores with its version."""
    folder = _run_folder(spark)
    write_odd_drops(spark, sf_dir, f"{folder}/export")
    facts = FactTable(f"{folder}/fact")
    build(spark, f"{folder}/export", facts, run_ts=dt.datetime.now(dt.timezone.utc))
    stored = facts.history(spark).select(F.explode("metrics").alias("metric", "value"))
    return stored.filter(~F.col("metric").isin("standby_files", "priority_files"))


@query(_DROP_SQL)
def daily_chain(spark, sf_dir):
    """List, plan, merge and report in one go."""
    folder = _run_folder(spark)
    write_drops(spark, sf_dir, f"{folder}/export")
    facts = FactTable(f"{folder}/fact")
    soon = dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=1)
    run_daily(spark, f"{folder}/export", facts, f"{folder}/out", run_ts=soon)
    return facts.read(spark)


@query(_DROP_SQL)
def stream_of_drops(spark, sf_dir):
    folder = _run_folder(spark)
    write_drops(spark, sf_dir, f"{folder}/export")
    facts = FactTable(f"{folder}/fact")
    stream_updates(spark, f"{folder}/export/*/*", facts, f"{folder}/checkpoint").awaitTermination()
    return facts.read(spark)


def _replace_live_files(spark: SparkSession, written: str, root: str) -> None:
    """Move the one CSV file of each folder below ``written`` over the live file of its property."""
    fs = spark._jvm.org.apache.hadoop.fs
    store = fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for found in store.globStatus(fs.Path(f"{written}/*/*/part-*.csv")):
        part = found.getPath()
        prop, family = part.getParent(), part.getParent().getParent()
        target = fs.Path(f"{root}/{family.getName()}/{prop.getName()}/current.csv")
        store.delete(target, False)
        store.mkdirs(target.getParent())
        store.rename(part, target)


@query(_DROP_SQL)
def stream_of_rewrites(spark, sf_dir):
    """A stream over live files that are rewritten with all events after a run on half of them."""
    folder = _run_folder(spark)
    facts, events = FactTable(f"{folder}/fact"), drop_events(spark, sf_dir)
    for k, part in enumerate((events.filter(F.col("event_id") % 2 == 0), events)):
        _write_families(f"{folder}/run-{k}", standby_drops(part), priority_drops(part), files=1)
        _replace_live_files(spark, f"{folder}/run-{k}", f"{folder}/export")
        stream_rewrites(
            spark, f"{folder}/export", facts, f"{folder}/checkpoint", slack_seconds=0
        ).awaitTermination()
    return facts.read(spark)


@query(EVENT_FACTS)
def restore_version(spark, sf_dir):
    """A first version, an empty second one, and the first again."""
    facts = FactTable(f"{_run_folder(spark)}/fact")
    now = dt.datetime.now(dt.timezone.utc)
    adopt(spark, facts, event_facts(spark, sf_dir), run_id="first", listed_at=None, at=now)
    adopt(spark, facts, facts.read(spark).limit(0), run_id="second", listed_at=None, at=now)
    restore(spark, facts, 1, run_id="third", at=now)
    return facts.read(spark)


@query("""
    SELECT 'U' || user_id AS entity_code, max(strftime(ts, '%Y-%m-%d')) AS latest_observation_date
    FROM events GROUP BY 1""")
def latest_csv_round_trip(spark, sf_dir):
    folder = _run_folder(spark)
    facts = FactTable(f"{folder}/fact")
    now = dt.datetime.now(dt.timezone.utc)
    adopt(spark, facts, event_facts(spark, sf_dir), run_id="first", listed_at=None, at=now)
    latest(spark, facts, f"{folder}/latest.csv")
    return spark.read.option("header", True).csv(f"{folder}/latest.csv")


# ---- summaries kept over three updates ----------------------------------------------------
def _third(k: int) -> Column:
    return F.floor(F.col("wait_time_minutes") / 7) % 3 == k


def _in_three_updates(spark: SparkSession, sf_dir: str, summaries: list) -> FactTable:
    """Event facts published as three segments, with the summaries brought up to date after each."""
    facts, rows, last = FactTable(f"{_run_folder(spark)}/fact"), event_facts(spark, sf_dir), None
    for k in range(3):
        run_id = new_run_id()
        write_facts(rows.filter(_third(k)), facts.segment_path(run_id))
        last = publish(
            spark,
            facts,
            last,
            run_id=run_id,
            kind=UPDATE,
            segments=[*(last.segments if last else []), run_id],
            listed_at=None,
            published_at=dt.datetime.now(dt.timezone.utc),
        )
        for summary in summaries:
            summarize(spark, facts, summary)
    return facts


@query("""
    SELECT 'U' || user_id AS entity_code, max(strftime(ts, '%Y-%m-%d')) AS latest_observation_date
    FROM events GROUP BY 1""")
def latest_incremental(spark, sf_dir):
    """The latest report after three updates, each of which read its own segment only."""
    return summarize(spark, _in_three_updates(spark, sf_dir, [LATEST]), LATEST)


@query("SELECT least(count(*), 1000) AS rows, least(count(*), 1000) AS of_whole_sample FROM events")
def sample_merged(spark, sf_dir):
    """The sample kept over three updates: its rows, and those that the sample of the whole table has too."""
    summary = sample_summary(1000)
    facts = _in_three_updates(spark, sf_dir, [summary])
    whole, kept = uniform_sample(facts.read(spark), 1000), summarize(spark, facts, summary)
    return kept.agg(F.count(F.lit(1)).alias("rows")).crossJoin(
        kept.intersectAll(whole).agg(F.count(F.lit(1)).alias("of_whole_sample"))
    )


_SPANS = [("2024-01-01", "2024-01-01"), ("2024-01-08", "2024-01-14"), ("2024-01-01", "2024-12-31")]


@query(" UNION ALL ".join(
    f"""SELECT '{first}' AS first_day, '{last}' AS last_day, count(DISTINCT user_id) AS entities, true AS within_3_percent
    FROM events WHERE strftime(ts, '%Y-%m-%d') BETWEEN '{first}' AND '{last}'""" for first, last in _SPANS
))
def entities_by_sketch(spark, sf_dir):
    """Distinct entities of three spans, counted, and whether the kept daily sketches come close."""
    facts = _in_three_updates(spark, sf_dir, [ENTITIES_BY_DAY])
    sketches = summarize(spark, facts, ENTITIES_BY_DAY)
    found = []
    for first, last in _SPANS:
        day = F.substring("observed_at", 1, 10)
        exact = entity_count(facts.read(spark).filter(day.between(first, last)))
        guess = entities_between(sketches, first, last).withColumnRenamed("entities", "_estimate")
        close = F.abs(F.col("_estimate") - F.col("entities")) <= 0.03 * F.col("entities")
        found.append(exact.crossJoin(guess).select(
            F.lit(first).alias("first_day"), F.lit(last).alias("last_day"), "entities", close.alias("within_3_percent")
        ))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(f"SELECT path AS s3_key FROM ({_MANIFEST_SQL}) WHERE m > {_MARK_SQL}")
def needs_round_trip(spark, sf_dir):
    """A needs list written, found as the newest of its folder and read back."""
    folder = _run_folder(spark)
    files = event_manifest(spark, sf_dir).withColumn("length", F.lit(1).cast("bigint"))
    wanted = needs_processing(files, event_watermark(spark, sf_dir), RUN_TS)
    write_needs(wanted, f"{folder}/{RUN_PREFIX}20240131.csv", NEW_YORK)
    return read_needs(spark, newest_needs(spark, folder))


@query(f"""
    SELECT path, strftime(m, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS modified,
           CASE WHEN path NOT LIKE 'current_%' OR path LIKE 'current_test_%' THEN NULL
                WHEN m < TIMESTAMP '2024-01-31' - INTERVAL 48 HOUR THEN 'VERY_STALE'
                WHEN m < TIMESTAMP '2024-01-31' - INTERVAL 24 HOUR THEN 'STALE' END AS staleness
    FROM ({_MANIFEST_SQL}) WHERE m >= TIMESTAMP '2024-01-31' - INTERVAL 31 DAY""")
def freshness_files(spark, sf_dir):
    files = event_manifest(spark, sf_dir).withColumn("length", F.lit(1).cast("bigint"))
    found = freshness(files, event_watermark(spark, sf_dir), RUN_TS, zone=NEW_YORK).recent
    return found.select("path", iso_utc(F.col("modificationTime")).alias("modified"), "staleness")


@query(f"""
    WITH f AS ({EVENT_FACTS}), e AS (SELECT * FROM f WHERE observed_at < '2024-01-20')
    SELECT * FROM e UNION ALL
    (SELECT DISTINCT * FROM f EXCEPT SELECT * FROM e)""")
def merge_large(spark, sf_dir):
    """The merge of candidates too large to broadcast."""
    facts = event_facts(spark, sf_dir)
    existing, fresh = facts.filter(F.col("observed_at") < "2024-01-20"), distinct_rows(facts)
    new = anti_join(fresh, existing, extent=measure(fresh), broadcast_bytes=0)
    return existing.unionByName(new)


@query(f"""
    WITH f AS ({EVENT_FACTS}), e AS (SELECT * FROM f WHERE observed_at < '2024-01-20')
    SELECT * FROM e UNION ALL SELECT * FROM e UNION ALL
    (SELECT DISTINCT * FROM f EXCEPT SELECT * FROM e)""")
def merge_keeps_copies(spark, sf_dir):
    facts = event_facts(spark, sf_dir)
    early = facts.filter(F.col("observed_at") < "2024-01-20")
    return merge(early.unionByName(early), facts, extent=measure(distinct_rows(facts)))


# ---- clock changes of 2024 in New York: +00:00 less five hours, less four from March to November
def _clock_rows(spark: SparkSession, sf_dir: str, start: str, fold: str) -> DataFrame:
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("o_orderkey") % 180).cast("int"))
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.expr(f"timestamp_ntz'{start}'") + minutes).alias("l")
    )
    return localize(df, "l", NEW_YORK, "observed_at", fold=fold).select("o_orderkey", "observed_at")


@query("""
    WITH a AS (SELECT o_orderkey, TIMESTAMP '2024-03-10 01:00:00' + to_minutes(o_orderkey % 180) AS l FROM orders)
    SELECT o_orderkey, CASE WHEN l < TIMESTAMP '2024-03-10 02:00:00' THEN strftime(l, '%Y-%m-%dT%H:%M:%S') || '-05:00'
        WHEN l < TIMESTAMP '2024-03-10 03:00:00' THEN '2024-03-10T03:00:00-04:00'
        ELSE strftime(l, '%Y-%m-%dT%H:%M:%S') || '-04:00' END AS observed_at FROM a""")
def dst_gap(spark, sf_dir):
    return _clock_rows(spark, sf_dir, "2024-03-10 01:00:00", "earlier")


def _fold_sql(rule: str, repeated: str) -> str:
    return f"""
    SELECT '{rule}' AS rule, o_orderkey, CASE
        WHEN l < TIMESTAMP '2024-11-03 01:00:00' THEN strftime(l, '%Y-%m-%dT%H:%M:%S') || '-04:00'
        WHEN l < TIMESTAMP '2024-11-03 02:00:00' THEN {repeated}
        ELSE strftime(l, '%Y-%m-%dT%H:%M:%S') || '-05:00' END AS observed_at
    FROM (SELECT o_orderkey, TIMESTAMP '2024-11-03 00:30:00' + to_minutes(o_orderkey % 180) AS l FROM orders)"""


@query(" UNION ALL ".join([
    _fold_sql("earlier", "strftime(l, '%Y-%m-%dT%H:%M:%S') || '-04:00'"),
    _fold_sql("later", "strftime(l, '%Y-%m-%dT%H:%M:%S') || '-05:00'"),
    _fold_sql("null", "NULL"),
]))
def dst_fold(spark, sf_dir):
    frames = [
        _clock_rows(spark, sf_dir, "2024-11-03 00:30:00", rule).select(F.lit(rule).alias("rule"), "*")
        for rule in ("earlier", "later", "null")
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


# ---- the repeated hour by the order of a file's rows ------------------------------------------
# Orders stand for rows of 40 files. Files of even numbers are in the order of true time, so the clock steps back
# once; the others are in no order. Elapsed minutes since 00:30 pass the change at 90.
_INFER_SQL = """
    SELECT o_orderkey, o_custkey % 40 AS file, (o_orderkey * 7) % 180 AS elapsed,
           CASE WHEN o_custkey % 40 % 2 = 0 THEN (o_orderkey * 7) % 180 * 100000000 + o_orderkey ELSE o_orderkey END AS place,
           TIMESTAMP '2024-11-03 00:30:00' + to_minutes(CASE WHEN (o_orderkey * 7) % 180 < 90 THEN (o_orderkey * 7) % 180
                                                             ELSE (o_orderkey * 7) % 180 - 60 END) AS l FROM orders"""


@query(f"""
    WITH r AS ({_INFER_SQL}),
    steps AS (SELECT *, coalesce(l < lag(l) OVER (PARTITION BY file ORDER BY place), false)::INT AS step
              FROM r WHERE l >= TIMESTAMP '2024-11-03 01:00:00' AND l < TIMESTAMP '2024-11-03 02:00:00'),
    seconds AS (SELECT o_orderkey, sum(step) OVER (PARTITION BY file) = 1
                       AND sum(step) OVER (PARTITION BY file ORDER BY place) = 1 AS second FROM steps)
    SELECT r.o_orderkey, strftime(l, '%Y-%m-%dT%H:%M:%S') || CASE
        WHEN l < TIMESTAMP '2024-11-03 02:00:00' AND NOT coalesce(second, false) THEN '-04:00' ELSE '-05:00' END AS observed_at
    FROM r LEFT JOIN seconds s ON s.o_orderkey = r.o_orderkey""")
def dst_inferred(spark, sf_dir):
    elapsed = (F.col("o_orderkey") * 7 % 180).cast("int")
    shown = F.when(elapsed < 90, elapsed).otherwise(elapsed - 60)
    in_order = F.col("o_custkey") % 40 % 2 == 0
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_custkey") % 40).alias("file"),
        F.when(in_order, elapsed * F.lit(100000000).cast("bigint") + F.col("o_orderkey"))
        .otherwise(F.col("o_orderkey"))
        .alias("place"),
        (F.expr("timestamp_ntz'2024-11-03 00:30:00'") + F.make_dt_interval(F.lit(0), F.lit(0), shown)).alias("l"),
    )
    found = localize(infer_second(rows, "l", NEW_YORK, ["file"], "place"), "l", NEW_YORK, "observed_at", fold="infer")
    return found.select("o_orderkey", "observed_at")


# ---- day before month or month before day, by file --------------------------------------------
# Orders stand for rows of 50 files of five kinds: day first, month first, both, days of one March that could be months,
# and one day that reads alike either way.
_DAY_ORDER_SQL = """
    SELECT o_custkey % 50 AS file, CASE o_custkey % 5
        WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y')
        WHEN 2 THEN CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%m/%d/%Y') END
        WHEN 3 THEN (day(o_orderdate) % 12 + 1) || '/3/1995' ELSE '5/5/1995' END AS text FROM orders"""


@query(f"""
    WITH p AS (SELECT file, regexp_extract(text, '^(\\d+)/', 1) AS a, regexp_extract(text, '/(\\d+)/', 1) AS b,
                      right(text, 4) AS y FROM ({_DAY_ORDER_SQL})),
    d AS (SELECT file, TRY_CAST(y || '-' || lpad(b, 2, '0') || '-' || lpad(a, 2, '0') AS DATE) AS dm,
                 TRY_CAST(y || '-' || lpad(a, 2, '0') || '-' || lpad(b, 2, '0') AS DATE) AS md FROM p),
    g AS (SELECT file, count(*) AS dates, count(*) FILTER (md IS NULL AND dm IS NOT NULL) AS only_day,
                 count(*) FILTER (dm IS NULL AND md IS NOT NULL) AS only_month,
                 max(dm) - min(dm) AS span_day, max(md) - min(md) AS span_month FROM d GROUP BY file)
    SELECT file, dates, CASE WHEN only_day > 0 AND only_month > 0 THEN 'mixed' WHEN only_day > 0 THEN 'day_first'
        WHEN only_month > 0 THEN 'month_first' WHEN span_day < span_month THEN 'day_first'
        WHEN span_day > span_month THEN 'month_first' ELSE 'ambiguous' END AS day_order FROM g""")
def day_order_by_file(spark, sf_dir):
    day, month = (F.lpad(text_of(f("o_orderdate")), 2, "0") for f in (F.dayofmonth, F.month))
    year = text_of(F.year("o_orderdate"))
    day_first, month_first = F.concat_ws("/", day, month, year), F.concat_ws("/", month, day, year)
    kind = F.col("o_custkey") % 5
    text = (
        F.when(kind == 0, day_first)
        .when(kind == 1, month_first)
        .when(kind == 2, F.when(F.col("o_orderkey") % 2 == 0, day_first).otherwise(month_first))
        .when(kind == 3, F.concat(text_of(F.dayofmonth("o_orderdate") % 12 + 1), F.lit("/3/1995")))
        .otherwise("5/5/1995")
    )
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("file"), text.alias("text"))
    return day_orders(rows, "file", "text")


@query(_DROP_SQL)
def build_day_orders(spark, sf_dir):
    """Drops of which some properties give the day first and the others the month."""
    folder = _run_folder(spark)
    events = drop_events(spark, sf_dir)
    ts = text_of(F.col("ts"))
    year, month, day, clock = (F.substring(ts, *at) for at in ((1, 4), (6, 2), (9, 2), (11, 99)))
    day_first = F.col("user_id") % 2 == 0
    written = F.concat(F.concat_ws("/", F.when(day_first, day).otherwise(month), F.when(day_first, month).otherwise(day), year), clock)
    standby = standby_drops(events.withColumn("day_first", day_first).withColumn("ts", written), "day_first")
    for kind in (True, False):
        part = standby.filter(F.col("day_first") == kind)
        for prop in PROPERTIES:
            part.filter(F.col("prop") == prop).drop("prop", "day_first").write.option("header", True).csv(
                f"{folder}/export/wait_times/{prop}/{'day' if kind else 'month'}"
            )
    for prop in PROPERTIES:
        priority_drops(events).filter(F.col("prop") == prop).drop("prop").write.option("header", True).csv(
            f"{folder}/export/fastpass_times/{prop}"
        )
    facts = FactTable(f"{folder}/fact")
    now = dt.datetime.now(dt.timezone.utc)
    build(spark, f"{folder}/export", facts, run_ts=now, rules=Rules(day_order="infer"))
    return facts.read(spark)
