"""Needs-processing plan and the tables behind the freshness report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.functions.timestamps import local_text, report_zone
from obsledger.operators.freshness import distinct_days, staleness, top_needs
from obsledger.schema import DAYS_BACK, STALE_HOURS, TOP_NEEDS, VERY_STALE_HOURS
from obsledger.sources.manifest import (
    newer_than,
    newest_first,
    recent,
    timestamp_literal,
)
from obsledger.sources.table import FactTable, to_micros


@dataclass
class Freshness:
    """``table``: one row; ``recent``: newest first; ``days``: one row."""

    table: DataFrame
    recent: DataFrame
    days: DataFrame
    needs: DataFrame
    top: DataFrame


def watermark_of(spark: SparkSession, table: FactTable) -> DataFrame:
    """The table's listing time as a one-row frame; null if never published."""
    micros = to_micros(table.watermark(spark))
    return spark.createDataFrame([(micros,)], "us bigint").select(
        F.timestamp_micros("us").alias("modified")
    )


def needs_processing(
    manifest: DataFrame,
    watermark: DataFrame,
    run_ts: dt.datetime,
    *,
    days_back: int = DAYS_BACK,
) -> DataFrame:
    """Recent files strictly newer than the table."""
    window = recent(manifest, timestamp_literal(run_ts), days_back)
    return newer_than(window, watermark)


def freshness(
    manifest: DataFrame,
    watermark: DataFrame,
    run_ts: dt.datetime,
    *,
    zone: str | None = None,
    days_back: int = DAYS_BACK,
    stale_hours: int = STALE_HOURS,
    very_stale_hours: int = VERY_STALE_HOURS,
    top: int = TOP_NEEDS,
) -> Freshness:
    """All tables of the report from one stored manifest."""
    zone = zone or report_zone()
    now = timestamp_literal(run_ts)
    window = recent(manifest, now, days_back)
    needs = newer_than(window, watermark)
    flagged = window.select(
        "path",
        "modificationTime",
        "length",
        local_text(F.col("modificationTime"), zone).alias("modified_local"),
        staleness(
            F.col("path"),
            F.col("modificationTime"),
            now,
            stale_hours=stale_hours,
            very_stale_hours=very_stale_hours,
        ).alias("staleness"),
    )
    mark = watermark.toDF("modified").select(
        "modified",
        local_text(F.col("modified"), zone).alias("modified_local"),
        F.col("modified").isNotNull().alias("found"),
    )
    return Freshness(
        table=mark,
        recent=newest_first(flagged),
        days=distinct_days(window),
        needs=newest_first(needs),
        top=top_needs(needs, top),
    )
