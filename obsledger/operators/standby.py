"""Standby drops -> posted and actual observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.functions.numeric import coerce_double, half_even, in_range
from obsledger.functions.text import canonical_code, null_if_na, strip
from obsledger.functions.timestamps import ensure_offset
from obsledger.schema import ACTUAL, KEYS, POSTED
from obsledger.sources.drops import FILE, FILE_ORDER


def unpivot_waits(
    df: DataFrame, ids: list[str], posted: str | None, actual: str | None
) -> DataFrame:
    """One row per wait column and input row, tagged by kind; nulls included."""
    names = {kind: c for kind, c in ((POSTED, posted), (ACTUAL, actual)) if c is not None}
    if not names:
        return df.select(
            *ids,
            F.lit(None).cast("string").alias("wait_time_type"),
            F.lit(None).cast("double").alias("wait_time_minutes"),
        ).filter(F.lit(False))
    wide = df.select(*ids, *[F.col(c).alias(kind) for kind, c in names.items()])
    return wide.unpivot(ids, list(names), "wait_time_type", "wait_time_minutes")


def normalize_standby(
    raw: DataFrame, zone: str, *, fold: str = "earlier", day_first: bool = False
) -> DataFrame:
    """The four columns from raw standby rows of one zone.

    The first filter looks at raw texts only: a filter on parsed values would be
    pushed below the projection and parse every row twice. Each row is localised
    once, before it is unpivoted; the range filter then sees parsed numbers. ``fold="infer"`` needs
    the columns FILE and FILE_ORDER. ``day_first``: how dates such as 3/4/2024 are read.
    """
    df = raw.filter(
        null_if_na(F.col("entity_code")).isNotNull()
        & null_if_na(F.col("observed_at")).isNotNull()
        & (
            F.col("submitted_posted_time").isNotNull()
            | F.col("submitted_actual_time").isNotNull()
        )
    ).select(
        *[c for c in (FILE, FILE_ORDER) if c in raw.columns],
        canonical_code(F.col("entity_code")).alias("entity_code"),
        strip(F.col("observed_at")).alias("observed_at"),
        half_even(coerce_double(F.col("submitted_posted_time"))).alias("posted"),
        half_even(coerce_double(F.col("submitted_actual_time"))).alias("actual"),
    )
    df = ensure_offset(
        df, "observed_at", zone, fold=fold, by=[FILE], order=FILE_ORDER, day_first=day_first
    )
    long = unpivot_waits(df, ["entity_code", "observed_at"], "posted", "actual").filter(
        in_range(F.col("wait_time_minutes"))
    )
    if fold == "null":
        long = long.filter(F.col("observed_at").isNotNull())
    return long.select(
        *KEYS[:3], F.col("wait_time_minutes").cast("bigint").alias("wait_time_minutes")
    )
