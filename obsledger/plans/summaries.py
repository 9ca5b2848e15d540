"""Summaries of the published table that are kept up to date from new segments alone.

A summary is a small table that merges: the summary of two parts follows from
the parts' summaries. Segments never change, so a stored summary stays right for
the segments it was made from, and a later version costs a read of the others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsledger.operators.explore import daily_sketches, latest_per_entity, merge_latest, merge_sketches
from obsledger.operators.sampling import merge_samples, uniform_sample
from obsledger.schema import FACT_SCHEMA, SAMPLE_K, SAMPLE_SEED
from obsledger.session import new_run_id
from obsledger.sources.manifest import is_path_missing
from obsledger.sources.table import FactTable, read_facts

KEPT_SCHEMA = "segments array<string>, path string"


@dataclass(frozen=True)
class Summary:
    """How to make a summary from rows of the table and how to merge two of them.

    ``name`` tells stored summaries apart, so it holds every parameter that changes the rows.
    """

    name: str
    schema: T.StructType
    make: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame, DataFrame], DataFrame]


LATEST = Summary(
    "latest",
    T.StructType().add("entity_code", "string").add("latest_observation_date", "string"),
    latest_per_entity,
    merge_latest,
)

ENTITIES_BY_DAY = Summary(
    "entities-by-day",
    T.StructType().add("day", "string").add("sketch", "binary"),
    daily_sketches,
    merge_sketches,
)


def sample_summary(k: int = SAMPLE_K, seed: int = SAMPLE_SEED) -> Summary:
    return Summary(
        f"sample-{k}-{seed}",
        FACT_SCHEMA,
        lambda facts: uniform_sample(facts, k, seed=seed),
        lambda old, new: merge_samples(old, new, k=k, seed=seed),
    )


def summarize(spark: SparkSession, table: FactTable, summary: Summary) -> DataFrame:
    """The summary of the table's newest version, stored for the next call.

    Starts from the stored summary that covers most of the version's segments
    and no other one; without such (a first call, a version restored or adopted)
    the whole table is read. A summary is noted as stored, in one small file,
    after it was written whole, so a run that dies on the way costs the next one
    only that read. An empty or never published table gives an empty summary.
    """
    found = table.commit(spark)
    segments = found.segments if found else []
    if not segments:
        return spark.createDataFrame([], summary.schema)
    base = _best_base(spark, table, summary, segments)
    covered = set(base.segments) if base else set()
    fresh = [s for s in segments if s not in covered]
    stored = None if base is None else spark.read.schema(summary.schema).parquet(base.path)
    if not fresh:
        return stored
    made = summary.make(read_facts(spark, *[table.segment_path(s) for s in fresh]))
    merged = made if stored is None else summary.merge(stored, made)
    path = f"{_folder(table, summary)}/rows/{new_run_id()}"
    merged.select(*summary.schema.fieldNames()).write.option("compression", "zstd").parquet(path)
    note = spark.createDataFrame([(segments, path)], KEPT_SCHEMA)
    note.coalesce(1).write.mode("append").json(f"{_folder(table, summary)}/kept")
    return spark.read.schema(summary.schema).parquet(path)


def _folder(table: FactTable, summary: Summary) -> str:
    return f"{table.root.rstrip('/')}/summaries/{summary.name}"


def _best_base(spark: SparkSession, table: FactTable, summary: Summary, segments: list[str]):
    """(segments, path) of the stored summary to start from; None if there is none."""
    try:
        kept = spark.read.schema(KEPT_SCHEMA).json(f"{_folder(table, summary)}/kept")
    except AnalysisException as error:
        if not is_path_missing(error):
            raise
        return None
    now = F.array(*[F.lit(s) for s in segments])
    usable = kept.filter(F.size(F.array_except("segments", now)) == 0)
    return usable.orderBy(F.size("segments").desc(), "path").limit(1).first()
