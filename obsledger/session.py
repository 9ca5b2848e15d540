"""Session settings the jobs are written for, and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Every setting below is a size or a switch, never a row count, so the same
# values serve a laptop and a thousand executors. The number of shuffle
# partitions is no setting: ``run_session`` takes it from the bytes of a run.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.filterPushdown": "true",
    # HotSpot does not compile methods beyond 8000 bytes: better separate
    # operators than one interpreted stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the recommended settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def size_of(setting: str) -> int:
    """Bytes of a size setting such as ``128m`` or ``4194304b``."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]?)b?", setting.strip().lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[unit]


SHUFFLE_BYTES = 128 << 20
"""Input bytes for each shuffle partition of a run."""


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session of its own with this one's settings and ``settings``.

    Other threads of the caller's session, such as a stream, plan as before.
    """
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if spark.conf.isModifiable(key) and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    return own


def shuffle_width(bytes_read: int, least: int) -> int:
    """Shuffle partitions for so many input bytes; AQE merges what turns out small."""
    return max(least, -(-bytes_read // SHUFFLE_BYTES))


def _width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def run_session(spark: SparkSession, bytes_read: int) -> SparkSession:
    """A session whose shuffles are as wide as the run's input asks for."""
    width = shuffle_width(bytes_read, _width(spark))
    return session_with(spark, {"spark.sql.shuffle.partitions": str(width)})


TASK_BYTES = 16 << 20
"""Packed bytes of columns, or of shuffled rows, for each task of ``table_session``."""


def table_session(spark: SparkSession, bytes_read: int) -> SparkSession:
    """A session for aggregates of nearly as many keys as rows over ``bytes_read`` of Parquet.

    Their hash tables hold most rows of a task, and packed columns unpack to many times their size. So a task gets
    a fixed share of the bytes, of scans as of shuffles, however much there is to read; left to Spark, both shares
    grow until a split is 128 MB and a merged partition 64 MB.
    """
    wanted = {"spark.sql.shuffle.partitions": str(max(_width(spark), -(-bytes_read // (TASK_BYTES // 2))))}
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        if size_of(spark.conf.get(key)) > TASK_BYTES:
            wanted[key] = f"{TASK_BYTES}b"
    return session_with(spark, wanted)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session,
    where every task sees the same disk, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: no shared work folder")
    return _local_folder()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    # Not stored as a setting: Spark fixes this one when the session starts.
    return tempfile.mkdtemp(prefix="obsledger-")


def new_run_id() -> str:
    return uuid.uuid4().hex[:16]
