"""Local times, offsets and instants, independent of the session time zone.

Wall-clock values are ``timestamp_ntz``; their text comes from a cast, never
from ``date_format``, which would route them through the session zone. Offsets
come from ``to_utc_timestamp``/``from_utc_timestamp`` on epoch minutes, whose
zone argument is resolved once per task when it is a literal.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obsledger.functions.text import has_offset
from obsledger.schema import CLOCK_YEARS, REPORT_ZONE

# The form almost every stored time has; needs no reformatting.
CANONICAL = r"^\d{4}-\d\d-\d\d[ T]\d\d:\d\d:\d\d(?:\.\d+)?$"
NUMERIC_DATE = r"^(\d{1,2})[/\-](\d{1,2})[/\-](\d{4})(?!\d)"
ISO_LOCAL = (
    r"^\d{4}-\d{1,2}-\d{1,2}"
    r"(?:[ T]\d{1,2}(?::\d{1,2}(?::\d{1,2}(?:\.\d+)?)?)?)?$"
)


def _epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def _minutes_of_interval(iv: Column) -> Column:
    return (
        F.extract(F.lit("DAY"), iv).cast("bigint") * 1440
        + F.extract(F.lit("HOUR"), iv).cast("bigint") * 60
        + F.extract(F.lit("MINUTE"), iv).cast("bigint")
    )


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from ``start`` to ``end`` (both ``timestamp_ntz``)."""
    return _minutes_of_interval(end - start)


def epoch_minutes(local: Column) -> Column:
    """Minutes of a wall-clock value since 1970-01-01 00:00 on the same clock."""
    return minutes_between(_epoch(), local)


def wall_clock(epoch_seconds: Column) -> Column:
    """``timestamp_ntz`` that shows the given epoch seconds."""
    return _epoch() + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), epoch_seconds.cast("decimal(18,6)")
    )


def iso_seconds(local: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss``; fractions are cut."""
    text = local.cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))


def in_clock_range(local: Column) -> Column:
    """True for times a 64-bit nanosecond clock can hold, false for null.

    Written so that ``local`` occurs once: it is often a long expression.
    """
    return F.coalesce(F.abs(F.year(local) - 1970) <= CLOCK_YEARS, F.lit(False))


def local_timestamp(
    year: Column, month: Column, day: Column, hour: Column, minute: Column
) -> Column:
    """Wall-clock value from whole parts; an impossible date gives null."""
    return F.try_make_timestamp_ntz(
        year.try_cast("int"),
        month.try_cast("int"),
        day.try_cast("int"),
        hour.try_cast("int"),
        minute.try_cast("int"),
        F.lit(0).cast("decimal(8,6)"),
    )


def is_possible_date(year: Column, month: Column, day: Column) -> Column:
    """True for a calendar date within the range a nanosecond clock can hold."""
    return in_clock_range(local_timestamp(year, month, day, F.lit(0), F.lit(0)))


def _reordered(text: Column, day_first: bool) -> Column:
    """Bring y/M/d, M/d/y (or d/M/y) and compact dates into ISO order; cut a final am/pm."""
    c = F.regexp_replace(text, r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3")
    c = F.regexp_replace(c, NUMERIC_DATE, "$3-$2-$1" if day_first else "$3-$1-$2")
    c = F.regexp_replace(c, r"^(\d{4})(\d{2})(\d{2})(?=[ T]|$)", "$1-$2-$3")
    return F.regexp_replace(c, r"(?i)\s*[ap]m$", "")


def parse_local(df: DataFrame, text: str, out: str, *, day_first: bool = False) -> DataFrame:
    """Add ``out``: the wall clock in column ``text``, null if unreadable or zoned.

    Dates such as 3/4/2024 give the month first, or the day with ``day_first``.

    Canonical texts, the bulk of any drop, take one regular expression and one
    cast; the other forms are only tried on what is left. Each step is its own
    projection: nested, the steps would be copied into each other and the
    generated method would grow beyond what the JVM compiles.
    """
    c, canonical, ordered, local = F.col(text), "__canonical", "__ordered", "__parsed"
    df = df.withColumn(canonical, c.rlike(CANONICAL))
    df = df.withColumn(
        ordered, F.when(F.col(canonical), c).when(~has_offset(c), _reordered(c, day_first))
    )
    df = df.withColumn(
        local,
        F.when(
            F.col(canonical) | F.col(ordered).rlike(ISO_LOCAL),
            F.col(ordered).try_cast("timestamp_ntz"),
        ),
    )
    half_day = F.lower(F.substring(c, -2, 2))
    shift = (
        F.when((half_day == "pm") & (F.hour(local) < 12), 12)
        .when((half_day == "am") & (F.hour(local) == 12), -12)
        .otherwise(0)
    )
    df = df.withColumn(
        local,
        F.when(F.col(canonical), F.col(local)).otherwise(
            F.col(local) + F.make_dt_interval(F.lit(0), shift)
        ),
    )
    return df.withColumn(
        out, F.when(in_clock_range(F.col(local)), F.col(local))
    ).drop(canonical, ordered, local)


def offset_text(minutes: Column) -> Column:
    """``+HH:MM`` / ``-HH:MM``."""
    size = F.abs(minutes)
    return F.concat(
        F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(_div(size, 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )


def _to_utc(seconds: Column, zone: Column) -> Column:
    return F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(seconds), zone))


def _from_utc(seconds: Column, zone: Column) -> Column:
    return F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(seconds), zone))


# Columns that hold intermediate steps.
STEPS = ("__local", "__wall", "__utc", "__back", "__clock", "__second")


def computed_once(
    df: DataFrame, out: str, value: Column, kept: list[str] | None = None
) -> DataFrame:
    """Add or replace column ``out`` so that filters on it stay above it.

    A filter on a projected column is pushed below the projection with the whole
    expression copied in; through a chain of projections the copies multiply. A
    filter on a generator's output is not pushed, at the price of a one-element
    array per row.
    """
    rest = [c for c in (df.columns if kept is None else kept) if c != out]
    return df.select(*rest, F.explode(F.array(value)).alias(out))


SECOND = "__second"


def _repeated(wall: Column, utc: Column, zone: Column, df: DataFrame) -> DataFrame:
    """Add ``__late``, the later instant of each wall clock, and ``__repeats``, whether the clock shows it twice."""
    # One day on, any change is complete, so the later offset applies.
    tomorrow = utc + 86400
    df = df.withColumn("__late", wall - (_from_utc(tomorrow, zone) - tomorrow))
    late = F.col("__late")
    return df.withColumn("__repeats", (late > utc) & (_from_utc(late, zone) == wall))


def infer_second(df: DataFrame, local: str, zone: str | Column, by: list[str], order: str) -> DataFrame:
    """Add SECOND: rows that show a repeated time for the second time, by the order of the rows of each ``by``.

    Where the repeated times of a day step back exactly once along ``order``, what comes from that step on
    is the second hour. Without such a step, or with several, nothing is inferred and the caller's rule for
    single rows holds. Only rows of repeated hours are shuffled and ordered; equal times do not step back.
    """
    z = F.lit(zone) if isinstance(zone, str) else zone
    steps = df.withColumn("__wall", epoch_minutes(F.col(local)) * 60)
    steps = steps.withColumn("__utc", _to_utc(F.col("__wall"), z))
    steps = _repeated(F.col("__wall"), F.col("__utc"), z, steps)
    # Computed before the two filters on it, which would copy its many zone conversions into each other.
    steps = computed_once(steps, "__repeats", F.coalesce("__repeats", F.lit(False)), [*df.columns])
    twice = F.col("__repeats")
    single = steps.filter(~twice).withColumn(SECOND, F.lit(False))
    group = Window.partitionBy(*by, F.to_date(local)).orderBy(order)
    back = F.coalesce(F.col(local) < F.lag(local).over(group), F.lit(False)).cast("int")
    double = steps.filter(twice).withColumn("__step", back)
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = group.rowsBetween(Window.unboundedPreceding, 0)
    second = (F.sum("__step").over(whole) == 1) & (F.sum("__step").over(upto) == 1)
    return single.unionByName(double.withColumn(SECOND, second).drop("__step")).drop("__repeats")


def localize(
    df: DataFrame,
    local: str,
    zone: str | Column,
    out: str,
    *,
    fold: str = "earlier",
    text: Column | None = None,
    result: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add ``out``: the wall clock in column ``local`` as ISO text with offset.

    * A time skipped by a clock change becomes the first valid instant after
      the gap (for gaps of at most an hour, starting on the hour).
    * A repeated time takes the first occurrence (``fold="earlier"``), the
      second (``"later"``) or gives null (``"null"``); with ``"infer"`` it takes the second
      where column SECOND says so (see ``infer_second``), else the first.

    ``text`` may hold the ISO text of ``local`` if it is at hand, and ``result``
    may turn the finished text into what ``out`` is to hold. The steps are
    separate projections so that each is evaluated once per row, also if the
    caller filters or joins on the result.
    """
    if fold not in ("earlier", "later", "null", "infer"):
        raise ValueError(f"unknown fold rule: {fold}")
    z = F.lit(zone) if isinstance(zone, str) else zone
    wall, utc, back, late = F.col("__wall"), F.col("__utc"), F.col("__back"), F.col("__late")
    df = df.withColumn("__wall", epoch_minutes(F.col(local)) * 60)
    df = df.withColumn("__utc", _to_utc(wall, z))
    if fold != "earlier":
        df = _repeated(wall, utc, z, df)
        repeated = F.col("__repeats") & (F.col(SECOND) if fold == "infer" else F.lit(True))
        other = F.lit(None).cast("bigint") if fold == "null" else late
        df = df.withColumn("__utc", F.when(repeated, other).otherwise(utc)).drop("__late", "__repeats")
    df = df.withColumn("__back", _from_utc(utc, z))

    # Inside a gap: the length of the gap after the hour in which it starts.
    first_valid = (
        F.substring(
            iso_seconds(wall_clock(wall - F.pmod(wall, F.lit(3600)) + back - wall)), 1, 16
        ),
        F.lit(":00"),
    )
    plain = iso_seconds(F.col(local)) if text is None else text
    df = df.withColumn(
        "__clock", F.when(back == wall, plain).when(back != wall, F.concat(*first_valid))
    )
    stamped = F.concat(F.col("__clock"), offset_text(_div(back - utc, 60)))
    kept = [c for c in df.columns if c not in STEPS]
    return computed_once(df, out, stamped if result is None else result(stamped), kept)


def ensure_offset(
    df: DataFrame,
    column: str,
    zone: str | Column,
    *,
    fold: str = "earlier",
    by: list[str] | None = None,
    order: str | None = None,
    day_first: bool = False,
) -> DataFrame:
    """Give every readable local time in ``column`` an offset.

    Texts that already carry one, and texts that cannot be read, stay as they
    are; ``has_offset`` tells them apart afterwards. ``fold="infer"`` needs ``by`` and ``order``, the
    file of each row and its place there.
    """
    c = F.col(column)
    df = parse_local(df, column, "__local", day_first=day_first)
    if fold == "infer":
        df = infer_second(df, "__local", zone, by, order)
    plain = F.when(
        c.rlike(CANONICAL),
        F.concat(F.substring(c, 1, 10), F.lit("T"), F.substring(c, 12, 8)),
    ).otherwise(iso_seconds(F.col("__local")))

    def finished(stamped: Column) -> Column:
        if fold == "null":
            return F.when(F.col("__local").isNull(), c).otherwise(stamped)
        return F.coalesce(stamped, c)

    return localize(
        df, "__local", zone, column, fold=fold, text=plain, result=finished
    )


def observed_instant(observed_at: Column) -> Column:
    """Instant of a stored observation, for ordering across offsets."""
    return F.when(has_offset(observed_at), observed_at.try_cast("timestamp"))


# ---- instants for the reports ----------------------------------------------
def utc_wall(ts: Column) -> Column:
    """UTC wall clock of an instant, in whole seconds."""
    return wall_clock(F.unix_seconds(ts))


def iso_utc(ts: Column) -> Column:
    """ISO text of an instant in UTC; micros only if there are any."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1000000))
    fraction = F.when(
        micros > 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))
    ).otherwise(F.lit(""))
    return F.concat(
        iso_seconds(utc_wall(ts)),
        fraction,
        F.lit("+00:00"),
    )


def instant_in_utc(local: Column) -> Column:
    """Instant at which a UTC clock shows ``local``, in whole seconds."""
    return F.timestamp_seconds(epoch_minutes(local) * 60 + F.floor(F.second(local)))


def utc_date(ts: Column) -> Column:
    return F.to_date(utc_wall(ts))


def report_zone() -> str:
    """Zone of the report texts: ``TZ`` if it names one, else the default."""
    name = os.environ.get("TZ") or REPORT_ZONE
    try:
        ZoneInfo(name)
        return name
    except Exception:
        return REPORT_ZONE


def zone_abbreviations(zone: str, first: int = 1970, last: int = 2037) -> dict[int, str]:
    """Offset minutes -> abbreviation in use for ``zone`` (latest use wins)."""
    tz = ZoneInfo(zone)
    found: dict[int, str] = {}
    for year in range(first, last + 1):
        for month in range(1, 13):
            at = dt.datetime(year, month, 1, tzinfo=dt.timezone.utc).astimezone(tz)
            found[int(at.utcoffset().total_seconds() // 60)] = at.tzname()
    return found


def local_text(ts: Column, zone: str) -> Column:
    """``yyyy-MM-dd HH:mm:ss ABC (UTC-05:00)`` of an instant in ``zone``."""
    seconds = F.unix_seconds(ts)
    shifted = F.unix_seconds(F.from_utc_timestamp(ts, F.lit(zone)))
    offset = _div(shifted - seconds, 60)
    name = F.lit("")
    for minutes, abbreviation in zone_abbreviations(zone).items():
        name = F.when(offset == minutes, F.lit(abbreviation)).otherwise(name)
    return F.concat(
        F.substring(wall_clock(shifted).cast("string"), 1, 19),
        F.lit(" "),
        name,
        F.lit(" (UTC"),
        offset_text(offset),
        F.lit(")"),
    )


def run_stamp(at: dt.datetime) -> str:
    """``YYYYMMDD_HHMMSS`` of an aware time, in UTC."""
    return at.astimezone(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
