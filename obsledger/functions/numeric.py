"""Number parsing, rounding and the compact clock encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.schema import MAX_MINUTES

# Characters of a plain number. Spark's own cast to double also takes "5d",
# "5f", "0x1p3", "NaN" and "Infinity", which must count as unreadable here.
NUMBER_CHARS = r"^[\d\seE.+\-]+$"


def coerce_double(text: Column) -> Column:
    """Number in a text, or null.

    The guard also keeps most unreadable texts away from the cast, which would
    raise and catch an exception for each of them.
    """
    return F.when(text.rlike(NUMBER_CHARS), text.try_cast("double"))


def half_even(c: Column) -> Column:
    """Round to a whole number, halves to the even neighbour."""
    return F.rint(c)


def in_range(minutes: Column, upper: int = MAX_MINUTES) -> Column:
    """True for rounded minutes within 0..upper; null counts as outside."""
    return F.coalesce(minutes.between(0, upper), F.lit(False))


def whole(v: Column) -> Column:
    """The value as bigint if it is a whole number, else null; 7.0 is, 7.5 is not."""
    return F.when((v == F.rint(v)) & (F.abs(v) < 1e15), v).cast("bigint")


def clip(c: Column, low: int, high: int) -> Column:
    """Bound a value from below and above; it must not be null."""
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def split_hour(floored: Column, is_whole: Column) -> Column:
    """Hour of a compact clock value (H, HHMM or HHMMSS) given its floor.

    Null for null and for a fractional bare hour.
    """
    return (
        F.when(floored >= 10000, _div(floored, 10000))
        .when(floored >= 100, _div(floored, 100))
        .when(is_whole, floored)
    )


def split_minute(floored: Column, is_whole: Column) -> Column:
    """Minute of a compact clock value; null for a bare hour."""
    return F.when(floored >= 10000, _div(floored % 10000, 100)).when(
        (floored >= 100) & is_whole, floored % 100
    )


def split_clock(
    df: DataFrame, value: str, minute: Column, hour_out: str, minute_out: str
) -> DataFrame:
    """Add hour and minute of the compact clock value in column ``value``.

    The minute inside the compact value wins, then ``minute`` (a whole number or
    null), then 0. Values too large to be floored count as unreadable.
    """
    v, floored = F.col(value), "__floored"
    df = df.withColumn(floored, F.when(F.abs(v) < 1e15, F.floor(v)))
    f, is_whole = F.col(floored), F.col(floored) == v
    return df.withColumns(
        {
            hour_out: F.coalesce(split_hour(f, is_whole), F.lit(0)),
            minute_out: F.coalesce(split_minute(f, is_whole), minute, F.lit(0)),
        }
    ).drop(floored)
