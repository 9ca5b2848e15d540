"""Staleness of live files and the tables behind the freshness report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions.text import is_current
from obsledger.functions.timestamps import utc_date
from obsledger.schema import STALE_HOURS, TOP_NEEDS, VERY_STALE_HOURS

# The class names, oldest first.
VERY_STALE = "VERY_STALE"
STALE = "STALE"


def staleness(
    path: Column,
    modified: Column,
    run_ts: Column,
    *,
    stale_hours: int = STALE_HOURS,
    very_stale_hours: int = VERY_STALE_HOURS,
) -> Column:
    """Class of a live file by age, null if fresh or not a live file."""

    def older_than(hours: int) -> Column:
        return modified < run_ts - F.make_dt_interval(F.lit(0), F.lit(hours))

    return F.when(
        is_current(path),
        F.when(older_than(very_stale_hours), VERY_STALE).when(older_than(stale_hours), STALE),
    )


def distinct_days(manifest: DataFrame, mtime: str = "modificationTime") -> DataFrame:
    """Number of distinct UTC days among the modification times (one row)."""
    return manifest.agg(F.countDistinct(utc_date(F.col(mtime))).alias("days"))


def top_needs(
    needs: DataFrame, n: int = TOP_NEEDS, mtime: str = "modificationTime", path: str = "path"
) -> DataFrame:
    return needs.orderBy(F.desc(mtime), path).limit(n)
