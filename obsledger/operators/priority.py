"""Priority drops -> minutes until the offered return time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions.numeric import (
    clip,
    coerce_double,
    split_clock,
    whole,
)
from obsledger.functions.text import canonical_code, null_if_na
from obsledger.functions.timestamps import (
    computed_once,
    in_clock_range,
    infer_second,
    local_timestamp,
    localize,
)
from obsledger.operators.dedupe import keep_last
from obsledger.schema import (
    KEYS,
    PRIORITY,
    ROLLOVER_BELOW,
    SELLOUT_MINUTES,
    SELLOUT_RAW_HOUR,
)
from obsledger.sources.drops import FILE, FILE_ORDER

DOCUMENTED = "documented"
LEGACY = "legacy"


def day_minutes(hour: Column, minute: Column) -> Column:
    """Minutes since midnight; hours clip to 0..23 and minutes to 0..59."""
    return clip(hour, 0, 23) * 60 + clip(minute, 0, 59)


def roll_over(difference: Column) -> Column:
    """A return more than 15 minutes in the past belongs to the next day."""
    return F.when(difference < ROLLOVER_BELOW, difference + 1440).otherwise(difference)


def is_sellout(raw_hour: Column, hour: Column) -> Column:
    """Return hour that stands for "sold out": 80 or more within a raw 8000 or more.

    8000..9999 holds such an hour, and so does 800000 and up; what lies between
    is an ordinary HHMMSS time (101500 is 10:15:00).
    """
    return (raw_hour >= SELLOUT_RAW_HOUR) & (hour >= 80)


def add_wait_minutes(
    df: DataFrame,
    out: str,
    *,
    observed: tuple[str, Column],
    returned: tuple[str, Column],
    sellout: str = DOCUMENTED,
) -> DataFrame:
    """Add ``out``: minutes from the observed to the offered time, as bigint.

    ``observed`` and ``returned`` are a raw compact hour (a column name) and a
    whole minute. Also adds ``__hour`` and ``__minute``, the observed time.

    Both times fall on one date, so their difference is plain arithmetic on
    minutes of the day. ``documented`` gives 8888 for sold-out rows; ``legacy``
    applies the compact split a second time and so clips them to an ordinary
    time. Each step is a projection of its own, which keeps the generated code
    small enough to be compiled.
    """
    if sellout not in (DOCUMENTED, LEGACY):
        raise ValueError(f"unknown sell-out rule: {sellout}")
    df = split_clock(df, observed[0], observed[1], "__hour", "__minute")
    df = split_clock(df, returned[0], returned[1], "__return_hour", "__return_minute")
    hour, minute, raw = "__hour", "__minute", F.col(returned[0])
    if sellout == LEGACY:
        hour, minute, raw = "__hour2", "__minute2", F.col("__return_hour")
        df = split_clock(df, "__hour", F.col("__minute"), hour, minute)
        df = split_clock(
            df, "__return_hour", F.col("__return_minute"), "__return_hour", "__return_minute"
        )
        raw = F.col("__return_hour")
    df = df.withColumn(
        "__difference",
        day_minutes(F.col("__return_hour"), F.col("__return_minute"))
        - day_minutes(F.col(hour), F.col(minute)),
    )
    sold_out = (
        is_sellout(raw, F.col("__return_hour"))
        if sellout == DOCUMENTED
        else raw >= SELLOUT_RAW_HOUR
    )
    spare = ["__difference", "__return_hour", "__return_minute"]
    if sellout == LEGACY:
        spare += [hour, minute]
    return df.withColumn(
        out,
        F.when(sold_out, SELLOUT_MINUTES)
        .otherwise(roll_over(F.col("__difference")))
        .cast("bigint"),
    ).drop(*spare)


def _date(year: Column, month: Column, day: Column) -> Column:
    return local_timestamp(whole(year), whole(month), whole(day), F.lit(0), F.lit(0))


_DATE_PARTS = ["FYEAR", "FMONTH", "FDAY"]
_CLOCK_PARTS = ["FHOUR", "FMIN", "FWINHR", "FWINMIN"]


def readable() -> Column:
    """Raw rows that name an entity and a possible date."""
    parts = [coerce_double(F.col(c)) for c in _DATE_PARTS]
    return null_if_na(F.col("FATTID")).isNotNull() & in_clock_range(_date(*parts))


def parse_priority(raw: DataFrame, *, sellout: str = DOCUMENTED) -> DataFrame:
    """Entity, wall-clock time and minutes of every readable priority row.

    An impossible date or a missing entity drops its row alone. The date is
    assembled once, before the filter on it.
    """
    carried = [c for c in (FILE, FILE_ORDER) if c in raw.columns]
    df = raw.filter(null_if_na(F.col("FATTID")).isNotNull()).select(
        *carried,
        canonical_code(F.col("FATTID")).alias("entity_code"),
        *[coerce_double(F.col(c)).alias(c) for c in _DATE_PARTS + _CLOCK_PARTS],
    )
    df = computed_once(
        df,
        "__date",
        _date(*[F.col(c) for c in _DATE_PARTS]),
        [*carried, "entity_code", *_CLOCK_PARTS],
    )
    df = df.filter(in_clock_range(F.col("__date")))
    df = add_wait_minutes(
        df,
        "wait_time_minutes",
        observed=("FHOUR", whole(F.col("FMIN"))),
        returned=("FWINHR", whole(F.col("FWINMIN"))),
        sellout=sellout,
    )
    time_of_day = F.make_dt_interval(
        F.lit(0),
        clip(F.col("__hour"), 0, 23).cast("int"),
        clip(F.col("__minute"), 0, 59).cast("int"),
    )
    return df.select(
        *carried,
        "entity_code",
        (F.col("__date") + time_of_day).alias("observed_local"),
        "wait_time_minutes",
    )


def collapse_priority(parsed: DataFrame) -> DataFrame:
    """Per file, keep the last row of each entity and time; counts what it drops."""
    return keep_last(
        parsed,
        keys=[FILE, "entity_code", "observed_local"],
        value="wait_time_minutes",
        order=FILE_ORDER,
        keep_order=True,
    )


def finish_priority(
    collapsed: DataFrame, zone: str, *, fold: str = "earlier"
) -> DataFrame:
    """Offset text and constant type: the four columns."""
    if fold == "infer":
        collapsed = infer_second(collapsed, "observed_local", zone, [FILE], FILE_ORDER)
    df = localize(collapsed, "observed_local", zone, "observed_at", fold=fold)
    if fold == "null":
        df = df.filter(F.col("observed_at").isNotNull())
    return df.withColumn("wait_time_type", F.lit(PRIORITY)).select(*KEYS)
