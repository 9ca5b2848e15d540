"""Distinct rows and keep-last, both with map-side combine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.schema import KEYS


def distinct_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Whole-row distinct.

    The keys are the whole row, so the plan is a hash aggregate on both sides
    of the shuffle: copies of one row shrink to one per map task before they
    travel, however many there are.
    """
    names = KEYS if keys is None else keys
    return df.select(*names).distinct()


def keep_last(
    df: DataFrame, keys: list[str], value: str, order: str, *, keep_order: bool = False
) -> DataFrame:
    """Value with the greatest ``order`` per key, and how many rows it stands for; ``keep_order`` adds that order.

    ``order`` must be a bigint (or another fixed-width type): the buffer then
    fits a hash aggregate with map-side combine, with no sort and no window.
    """
    return df.groupBy(*keys).agg(
        F.max_by(value, order).alias(value),
        F.count(F.lit(1)).alias("source_rows"),
        *([F.max(order).alias(order)] if keep_order else []),
    )
