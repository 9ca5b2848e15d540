"""The published table: immutable segments plus an append-only commit log.

``<root>/segments/<run>/`` holds Parquet files that are never changed once
committed. ``<root>/commits/`` holds one JSON line per publish that names the
segments making up that version. Readers take the highest version, so a run
that dies half-way leaves nothing visible, and the version before a publish
stays readable as its backup without copying a byte.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.schema import FACT_SCHEMA, KEYS
from obsledger.sources.headers import UNREADABLE
from obsledger.sources.manifest import is_path_missing, scan_objects

COMMIT_SCHEMA = (
    "version bigint, run_id string, kind string, segments array<string>, "
    "listed_us bigint, published_us bigint, metrics map<string,bigint>"
)


QUARANTINE_SCHEMA = "path string, problem string"


class ConflictingPublish(RuntimeError):
    """Another run published this version first; the table is as that run left it."""


@dataclass(frozen=True)
class Commit:
    version: int
    run_id: str
    kind: str
    segments: list[str]
    listed_at: dt.datetime | None
    published_at: dt.datetime
    metrics: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class FactTable:
    root: str

    def segment_path(self, run_id: str) -> str:
        return f"{self.root.rstrip('/')}/segments/{run_id}"

    def staging_path(self, run_id: str) -> str:
        return f"{self.root.rstrip('/')}/staging/{run_id}"

    def quarantine_path(self, run_id: str) -> str:
        return f"{self.root.rstrip('/')}/quarantine/{run_id}"

    def quarantine(self, spark: SparkSession, run_id: str | None = None) -> DataFrame:
        """(path, problem) of the files that a run, by default the newest, set aside."""
        if run_id is None:
            found = self.commit(spark)
            run_id = None if found is None else found.run_id
        if run_id is not None:
            try:
                return spark.read.schema(QUARANTINE_SCHEMA).parquet(self.quarantine_path(run_id))
            except AnalysisException as error:
                if not is_path_missing(error):
                    raise
        return spark.createDataFrame([], QUARANTINE_SCHEMA)

    def left_out_path(self, run_id: str) -> str:
        return f"{self.root.rstrip('/')}/left-out/{run_id}"

    def left_out(self, spark: SparkSession, run_id: str) -> DataFrame | None:
        """(file, family, reason, fields) of the rows that a run left out; None if there were none."""
        try:
            return spark.read.parquet(self.left_out_path(run_id))
        except AnalysisException as error:
            if not is_path_missing(error):
                raise
            return None

    def unopened(self, spark: SparkSession, run_id: str | None = None) -> DataFrame:
        """Of the files set aside, those that could not be opened."""
        return self.quarantine(spark, run_id).filter(F.col("problem").startswith(UNREADABLE))

    def set_aside(self, spark: SparkSession, run_id: str, kept: DataFrame) -> None:
        """Store (path, problem) rows for a run that is about to publish; nothing if there are none."""
        if not kept.isEmpty():
            kept.coalesce(1).write.parquet(self.quarantine_path(run_id))

    @property
    def commit_path(self) -> str:
        return f"{self.root.rstrip('/')}/commits"

    def commit_file(self, version: int) -> str:
        return f"{self.commit_path}/{version:012d}.json"

    def history(self, spark: SparkSession) -> DataFrame | None:
        """All commits, or None if nothing was ever published.

        Only a path that is proven not to exist counts as absent; any other
        failure is raised, so an unreadable table is never taken for a new one.
        """
        try:
            return spark.read.schema(COMMIT_SCHEMA).option("mode", "FAILFAST").json(
                self.commit_path
            )
        except AnalysisException as error:
            if not is_path_missing(error):
                raise
            return None

    def commit(self, spark: SparkSession, version: int | None = None) -> Commit | None:
        """The newest commit, or the given version of it."""
        log = self.history(spark)
        if log is None:
            return None
        if version is not None:
            log = log.filter(F.col("version") == version)
        # A version is one file. Should a store let two runs write it all the
        # same, every reader takes the same one of them.
        top = log.orderBy(F.desc("version"), "published_us", "run_id").limit(1).collect()
        if not top:
            return None
        row = top[0]
        return Commit(
            row.version,
            row.run_id,
            row.kind,
            list(row.segments),
            from_micros(row.listed_us),
            from_micros(row.published_us),
            dict(row.metrics or {}),
        )

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The table at its newest (or a given) version; empty if never published."""
        found = self.commit(spark, version)
        if found is None and version is not None:
            raise ValueError(f"{self.root} has no version {version}")
        if found is None or not found.segments:
            return spark.createDataFrame([], FACT_SCHEMA)
        return read_facts(spark, *[self.segment_path(s) for s in found.segments])

    def watermark(self, spark: SparkSession) -> dt.datetime | None:
        """Time of the listing behind the newest version.

        None, also for a version that no full listing stands behind, means that
        every recent file still has to be read.
        """
        found = self.commit(spark)
        return None if found is None else found.listed_at


_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def to_micros(at: dt.datetime | None) -> int | None:
    return None if at is None else (at - _EPOCH) // dt.timedelta(microseconds=1)


def from_micros(micros: int | None) -> dt.datetime | None:
    return None if micros is None else _EPOCH + dt.timedelta(microseconds=micros)


def read_facts(spark: SparkSession, *paths: str) -> DataFrame:
    """Plain Parquet scan of the four columns (single file, folder or folders)."""
    return spark.read.schema(FACT_SCHEMA).parquet(*paths).select(*KEYS)


def parquet_modified(spark: SparkSession, path: str) -> DataFrame:
    """Newest modification time of a plain Parquet table, null if absent (one row)."""
    files = scan_objects(spark, path, csv_only=False)
    data = files.filter(~F.regexp_extract("path", r"([^/]*)$", 1).rlike(r"^[._]"))
    return data.agg(F.max("modificationTime").alias("modified"))
