"""Listing of the drops as a table, and the filters over it."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.functions.text import family_of, property_of
from obsledger.schema import (
    DEFAULT_ZONE,
    FAMILY_MARKERS,
    MANIFEST_SCHEMA,
    PROPERTIES,
    ZONES,
)
from obsledger.session import session_with


def is_path_missing(error: AnalysisException) -> bool:
    """True only for the one error that proves a path does not exist."""
    return error.getCondition() == "PATH_NOT_FOUND"


def escape_glob(path: str) -> str:
    """A path as a pattern that matches only itself."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def drop_prefixes(root: str, properties: list[str] | None = None) -> list[str]:
    """Every property crossed with both families, below ``root``."""
    return [
        f"{root.rstrip('/')}/{marker}/{prop}"
        for prop in (PROPERTIES if properties is None else properties)
        for marker in FAMILY_MARKERS.values()
    ]


def _prefix_glob(root: str, properties: list[str] | None) -> str:
    """All prefixes as one pattern, so that a property without drops is no error."""
    props = ",".join(PROPERTIES if properties is None else properties)
    markers = ",".join(FAMILY_MARKERS.values())
    return f"{escape_glob(root.rstrip('/'))}/{{{markers}}}/{{{props}}}"


def scan_objects(
    spark: SparkSession, paths: str | list[str], *, csv_only: bool = True
) -> DataFrame:
    """Path, modification time and size of every file below ``paths``.

    The content column is pruned, so no file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if csv_only:
        reader = reader.option("pathGlobFilter", "*.[cC][sS][vV]")
    try:
        return reader.load(paths).select(*MANIFEST_SCHEMA.fieldNames())
    except AnalysisException as error:
        if not is_path_missing(error):
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def scan_drops(
    spark: SparkSession,
    root: str,
    properties: list[str] | None = None,
    *,
    csv_only: bool = True,
) -> DataFrame:
    """Manifest of the drops of the given properties in both families."""
    return scan_objects(spark, _prefix_glob(root, properties), csv_only=csv_only)


def listing_session(spark: SparkSession) -> SparkSession:
    """A session for listings, planned by file count and not by bytes.

    A listing scan is planned like a read of the files behind it: 100 TB of
    drops would become hundreds of thousands of tasks that read nothing. With
    wide splits it is one task per core.
    """
    return session_with(spark, {"spark.sql.files.maxPartitionBytes": str(1 << 50)})


def snapshot(spark: SparkSession, manifest: DataFrame, path: str) -> DataFrame:
    """Store a listing once, sorted by path, and read it back.

    Recency, the needs list and the watermark must all come from the same
    listing; a lazy manifest would list again for each of them.
    """
    manifest.sortWithinPartitions("path").write.mode("errorifexists").parquet(path)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def zone_dimension(spark: SparkSession, zones: dict[str, str] | None = None) -> DataFrame:
    """Property -> zone as a small table (one row per listed property)."""
    rows = list((ZONES if zones is None else zones).items())
    return spark.createDataFrame(rows, "prop string, zone string")


def with_zone(
    df: DataFrame, zones: DataFrame, default: str = DEFAULT_ZONE, prop: str = "prop"
) -> DataFrame:
    """Look up the zone of each property; unlisted ones take the default.

    The dimension holds one row per property the caller lists by hand.
    """
    dim = zones.select(F.col("prop").alias("__prop"), F.col("zone").alias("__zone"))
    return (
        df.join(F.broadcast(dim), F.col(prop) == F.col("__prop"), "left")
        .withColumn("zone", F.coalesce("__zone", F.lit(default)))
        .drop("__prop", "__zone")
    )


def route(manifest: DataFrame) -> DataFrame:
    """Add family and property of each file; an unknown family stays null."""
    return manifest.withColumn("family", family_of(F.col("path"))).withColumn(
        "prop", property_of(F.col("path"))
    )


def timestamp_literal(at: dt.datetime) -> Column:
    """Instant as a literal that no session zone can move."""
    if at.tzinfo is None:
        raise ValueError("run time needs a time zone")
    micros = (at - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(
        microseconds=1
    )
    return F.timestamp_micros(F.lit(micros))


def recent(
    manifest: DataFrame, run_ts: Column, days_back: int, mtime: str = "modificationTime"
) -> DataFrame:
    """Files no older than ``days_back`` days at ``run_ts`` (bound included)."""
    return manifest.filter(
        F.col(mtime) >= run_ts - F.make_dt_interval(F.lit(days_back))
    )


def newer_than(
    manifest: DataFrame, watermark: DataFrame, mtime: str = "modificationTime"
) -> DataFrame:
    """Files strictly newer than the one-row ``watermark``; all if it is null.

    ``watermark`` must be a global aggregate, so it has exactly one row.
    """
    mark = watermark.toDF("__mark")
    return (
        manifest.crossJoin(F.broadcast(mark))
        .filter(F.col("__mark").isNull() | (F.col(mtime) > F.col("__mark")))
        .drop("__mark")
    )


def newest_first(
    manifest: DataFrame, mtime: str = "modificationTime", path: str = "path"
) -> DataFrame:
    return manifest.orderBy(F.desc(mtime), path)
