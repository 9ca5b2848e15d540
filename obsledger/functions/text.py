"""String expressions (Column in, Column out; no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obsledger.schema import (
    FAMILY_MARKERS,
    NA_TOKENS,
    PRIORITY_FAMILY,
    STANDBY,
)

# Every character that counts as white space at either end.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: a text that ends in Z, +HH:MM or +HHMM carries its own offset.
HAS_OFFSET = r"(?i)(?:Z|[+\-]\d{2}:?\d{2})\z"


def strip(c: Column) -> Column:
    """Remove all leading and trailing white space (``trim`` only takes blanks)."""
    return F.btrim(c, F.lit(WHITESPACE))


def null_if_na(c: Column) -> Column:
    """Null where the whole text is one of the missing-value tokens."""
    return F.when(~c.isin(NA_TOKENS), c)


def canonical_code(c: Column) -> Column:
    """Entity codes are compared upper-cased and stripped."""
    return strip(F.upper(c))


def has_offset(c: Column) -> Column:
    """True where the text ends in an offset; at most six characters decide."""
    return F.substring(c, -6, 6).rlike(HAS_OFFSET)


def segment_after(path: Column, marker: str) -> Column:
    """Path segment that follows ``marker``; empty text if there is none."""
    return F.regexp_extract(path, rf"(?:^|/){marker}/([^/]*)", 1)


def property_of(path: Column) -> Column:
    """Property code held in a drop's path, lower-cased; empty if unknown."""
    found = F.coalesce(
        *[
            F.when(F.length(segment_after(path, marker)) > 0, segment_after(path, marker))
            for marker in FAMILY_MARKERS.values()
        ],
        F.lit(""),
    )
    return strip(F.lower(found))


def family_of(path: Column) -> Column:
    """``standby``, ``priority`` or null; the standby marker is tested first."""
    return F.when(
        path.contains(f"/{FAMILY_MARKERS[STANDBY]}/"), F.lit(STANDBY)
    ).when(path.contains(f"/{FAMILY_MARKERS[PRIORITY_FAMILY]}/"), F.lit(PRIORITY_FAMILY))


def is_current(path: Column) -> Column:
    """Names of live files: contain ``current`` but not ``current_test``."""
    name = F.lower(path)
    return name.contains("current") & ~name.contains("current_test")


def date_part(observed_at: Column) -> Column:
    """Local date of an observation: its first ten characters."""
    return F.substring(observed_at, 1, 10)


def year_part(observed_at: Column) -> Column:
    """Year of an observation as a number; null if the text has none."""
    return F.substring(observed_at, 1, 4).try_cast("int")
