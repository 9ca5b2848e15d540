"""Writing segments and publishing versions of the table."""

from __future__ import annotations

import datetime as dt
import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.schema import FACT_SCHEMA
from obsledger.sources.table import (
    COMMIT_SCHEMA,
    Commit,
    ConflictingPublish,
    FactTable,
    to_micros,
)

BUILD = "build"
UPDATE = "update"
RESTORE = "restore"
ADOPT = "adopt"


def typed(df: DataFrame) -> DataFrame:
    """The four columns in their fixed order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in FACT_SCHEMA.fields])


def write_facts(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Zstd Parquet, split into files by ranges of time and sorted inside each.

    Files, row groups and pages then have narrow and nearly disjoint time ranges,
    which is what the next merge prunes on. A hot instant is split further by entity and type.
    """
    (
        typed(df)
        .repartitionByRange("observed_at", "entity_code", "wait_time_type")
        .sortWithinPartitions("observed_at", "entity_code", "wait_time_type")
        .write.mode(mode)
        .option("compression", "zstd")
        .parquet(path)
    )


def stage_facts(df: DataFrame, path: str) -> None:
    """Rows of a run on their way into a segment, as they come.

    A write by ranges of time computes its rows twice, for the bounds of the ranges first.
    """
    typed(df).write.option("compression", "zstd").parquet(path)


def publish(
    spark: SparkSession,
    table: FactTable,
    previous: Commit | None,
    *,
    run_id: str,
    kind: str,
    segments: list[str],
    listed_at: dt.datetime | None,
    published_at: dt.datetime,
    metrics: dict[str, int] | None = None,
) -> Commit:
    """Make a set of finished segments the newest version.

    The version becomes visible with one small file, so readers see the state
    before or after, never between. The version before stays intact as backup.
    """
    version = 1 if previous is None else previous.version + 1
    row = (
        version,
        run_id,
        kind,
        segments,
        to_micros(listed_at),
        to_micros(published_at),
        {k: int(v) for k, v in (metrics or {}).items()},
    )
    names = [f.split()[0] for f in COMMIT_SCHEMA.split(", ")]
    line = json.dumps(dict(zip(names, row, strict=True))) + "\n"
    _create(spark, table.commit_file(version), line.encode())
    done = table.commit(spark, version)
    if done is None or done.run_id != run_id:
        raise ConflictingPublish(f"version {version} of {table.root} belongs to another run")
    return done


def _create(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file that must not be there yet."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = store.create(target, False)
    except Py4JJavaError as error:
        if store.exists(target):
            raise ConflictingPublish(f"{path} was written by another run") from error
        raise
    out.write(data)
    out.close()


def restore(
    spark: SparkSession, table: FactTable, version: int, *, run_id: str, at: dt.datetime
) -> Commit:
    """Publish an earlier version again, with that version's own watermark."""
    wanted = table.commit(spark, version)
    if wanted is None:
        raise ValueError(f"{table.root} has no version {version}")
    # Open are the files that either version could not open.
    still = table.unopened(spark).unionByName(table.unopened(spark, wanted.run_id))
    table.set_aside(spark, run_id, still.dropDuplicates(["path"]))
    return publish(
        spark,
        table,
        table.commit(spark),
        run_id=run_id,
        kind=RESTORE,
        segments=wanted.segments,
        listed_at=wanted.listed_at,
        published_at=at,
        metrics=wanted.metrics,
    )


def adopt(
    spark: SparkSession,
    table: FactTable,
    facts: DataFrame,
    *,
    run_id: str,
    listed_at: dt.datetime | None,
    at: dt.datetime,
) -> Commit:
    """Take over rows of a plain Parquet table, copies included, as a new version."""
    previous = table.commit(spark)
    write_facts(facts, table.segment_path(run_id))
    table.set_aside(spark, run_id, table.unopened(spark))
    return publish(
        spark,
        table,
        previous,
        run_id=run_id,
        kind=ADOPT,
        segments=[run_id],
        listed_at=listed_at,
        published_at=at,
    )


def export(
    spark: SparkSession, table: FactTable, path: str, *, version: int | None = None
) -> None:
    """Write one version as a plain Parquet folder for other readers."""
    write_facts(table.read(spark, version), path)
