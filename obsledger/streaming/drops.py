"""Structured Streaming over the listing of the drops.

The stream carries file names, not rows: each micro-batch is a small manifest
that goes through the same update as the daily chain, so headers are probed
and layouts grouped exactly alike. Spark's file source never reports a path twice;
``stream_rewrites`` takes files that change in place again whenever they do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from obsledger.plans.update import update_from
from obsledger.sources.changes import changed_files
from obsledger.sources.table import FactTable

BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def drop_stream(
    spark: SparkSession, glob: str, *, max_files: int | None = None
) -> DataFrame:
    """Stream of the drops below ``glob``; file contents are pruned."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.[cC][sS][vV]")
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(glob).select("path", "modificationTime", "length")


def stream_updates(
    spark: SparkSession,
    glob: str,
    table: FactTable,
    checkpoint: str,
    *,
    max_files: int | None = None,
    **options,
) -> StreamingQuery:
    """Merge everything that has arrived, then stop.

    A batch that is replayed after a failure adds nothing twice, because the
    merge only takes rows the table does not hold. The watermark of the
    manifest-driven update stays where it was.
    """

    return _merged(drop_stream(spark, glob, max_files=max_files), table, checkpoint, options)


def stream_rewrites(
    spark: SparkSession,
    root: str,
    table: FactTable,
    checkpoint: str,
    *,
    slack_seconds: float = 1,
    **options,
) -> StreamingQuery:
    """Merge every CSV file below ``root`` that was written since the last run, rewritten ones included, then stop.

    Rows of a rewritten file that the table holds already are not added again; rows that
    the file no longer has stay, as in the manifest-driven update.
    """
    files = changed_files(spark, root, slack_seconds=slack_seconds)
    return _merged(files, table, checkpoint, options)


def _merged(files: DataFrame, table: FactTable, checkpoint: str, options: dict) -> StreamingQuery:
    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        update_from(
            batch.sparkSession,
            batch.select(F.col("path")),
            table,
            listed_at=None,
            **options,
        )

    return (
        files.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
