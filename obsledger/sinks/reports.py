"""CSV sinks. Each holds one row per file, per entity or per sampled row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.functions.timestamps import iso_utc, local_text
from obsledger.schema import KEYS, LATEST_COLUMNS


def write_csv(
    df: DataFrame,
    path: str,
    *,
    order: list[Column] | None = None,
    mode: str = "errorifexists",
    single_file: bool = True,
) -> None:
    """CSV with header; an empty frame still gives a header-only file.

    One file comes from one task. The rows are sorted by many before, each a range of them,
    and checkpointed; the one task then reads range after range and holds none of them.
    """
    if order and single_file:
        df = _sorted_for_one_task(df, order)
    elif order:
        df = df.orderBy(*order)
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def _sorted_for_one_task(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows that ``coalesce(1)`` takes in order.

    Only a checkpoint promises that: its files all have a place or none has, so its partitions are taken one
    after the other. Of shuffled or cached partitions, those with a known place may come first. A session without
    a checkpoint folder sorts all rows in the one task.
    """
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        return df.repartition(1).sortWithinPartitions(*order)
    return df.orderBy(*order).checkpoint()


def needs_rows(needs: DataFrame, zone: str) -> DataFrame:
    """Key, UTC time, local time and size of each listed file, newest first."""
    return _needs_columns(needs.orderBy(F.desc("modificationTime"), "path"), zone)


def _needs_columns(needs: DataFrame, zone: str) -> DataFrame:
    modified = F.col("modificationTime")
    return needs.select(
        F.col("path").alias("s3_key"),
        iso_utc(modified).alias("last_modified_utc"),
        local_text(modified, zone).alias("last_modified_local"),
        F.col("length").alias("size_bytes"),
    )


def write_needs(needs: DataFrame, path: str, zone: str, *, mode: str = "errorifexists") -> None:
    one = needs.repartition(1).sortWithinPartitions(F.desc("modificationTime"), "path")
    write_csv(_needs_columns(one, zone), path, mode=mode)


def write_latest(
    latest: DataFrame, path: str, *, mode: str = "overwrite", single_file: bool = True
) -> None:
    """Latest-date report, sorted by entity."""
    write_csv(
        latest.select(*LATEST_COLUMNS),
        path,
        order=[F.col("entity_code")],
        mode=mode,
        single_file=single_file,
    )


def write_sample(sample: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    write_csv(sample.select(*KEYS), path, mode=mode)
