"""A stream of the files below a folder that comes back to a file whenever it was written again.

Spark's file stream reports a path once. Here the offset is the pair (modification time, path) of the last file
reported, so a live file that is rewritten in place lies beyond it again. A batch is the files between two
offsets by a listing of the moment; a file that was rewritten since the batch was planned comes in a later one.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SOURCE = "changed_files"
SCHEMA = "path string, modificationTime timestamp, length bigint"
FILES_A_TASK = 4096

# Workers that list and read need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Place = tuple[int, str]
"""Modification time in nanoseconds, and path."""


@dataclass
class Files(InputPartition):
    rows: list[tuple[str, int, int]]


class ChangedFilesReader(DataSourceStreamReader):
    def __init__(self, root: str, suffix: str, slack_seconds: float) -> None:
        self.root, self.suffix, self.slack = root.rstrip("/"), suffix.lower(), slack_seconds

    def _listed(self, after: Place, upto: Place | None) -> list[tuple[Place, int]]:
        """Files with a place in (after, upto], in order."""
        from pyarrow import fs

        scheme, sep, rest = self.root.partition(":")
        if not sep or scheme == "file":
            store, target = fs.LocalFileSystem(), "/" + (rest if sep else self.root).lstrip("/")
        else:
            store, target = fs.FileSystem.from_uri(self.root.replace("s3a:", "s3:", 1))
        lead = self.root[: len(self.root) - len(target)]
        found = store.get_file_info(fs.FileSelector(target, recursive=True, allow_not_found=True))
        places = (
            ((f.mtime_ns or 0, lead + f.path), f.size or 0)
            for f in found
            if f.is_file and f.path.lower().endswith(self.suffix)
        )
        return sorted(x for x in places if after < x[0] and (upto is None or x[0] <= upto))

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        # A store of whole seconds may show another file with the listing's own second later.
        settled = dt.datetime.now(dt.timezone.utc).timestamp() - self.slack
        found = self._listed((-1, ""), (int(settled * 1e9), "\U0010ffff"))
        return dict(zip(("time", "path"), found[-1][0], strict=True)) if found else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Files]:
        found = self._listed((start["time"], start["path"]), (end["time"], end["path"]))
        rows = [(path, time, size) for (time, path), size in found]
        return [Files(rows[i : i + FILES_A_TASK]) for i in range(0, len(rows), FILES_A_TASK)] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        for path, time, size in partition.rows:
            yield path, dt.datetime.fromtimestamp(time // 1000 / 1e6, dt.timezone.utc), size


class ChangedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ChangedFilesReader:  # noqa: N802
        options = self.options
        return ChangedFilesReader(options["path"], options.get("suffix", ""), float(options.get("slackSeconds", "1")))


def changed_files(spark: SparkSession, root: str, *, suffix: str = ".csv", slack_seconds: float = 1) -> DataFrame:
    """Stream of path, modificationTime and length of the files below ``root``, again after each rewrite.

    Files of the last ``slack_seconds`` before a listing wait for the next one.
    """
    spark.dataSource.register(ChangedFiles)
    reader = spark.readStream.format(SOURCE).option("suffix", suffix).option("slackSeconds", str(slack_seconds))
    return reader.load(root)
