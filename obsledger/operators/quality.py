"""Counts that flag doubtful rows without changing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions.text import has_offset
from obsledger.schema import PRIORITY, SELLOUT_MINUTES


def flags(df: DataFrame) -> dict[str, Column]:
    """Name -> condition of each flag over the four columns."""
    return {
        "no_offset": ~has_offset(F.col("observed_at")),
        "blank_entity": F.col("entity_code") == "",
        "negative_wait": F.col("wait_time_minutes") < 0,
        "sold_out": (F.col("wait_time_type") == PRIORITY)
        & (F.col("wait_time_minutes") == SELLOUT_MINUTES),
    }


def quality(df: DataFrame) -> DataFrame:
    """One row: the table's size and how many rows carry each flag."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(condition).alias(name) for name, condition in flags(df).items()],
    )
