"""Full rebuild of the table from all drops."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.operators.dedupe import distinct_rows
from obsledger.operators.sampling import uniform_sample
from obsledger.plans.observe import SHIFTED, UNDATED, Observed, Rules, observe, rows_left_out
from obsledger.schema import SAMPLE_K, SAMPLE_SEED
from obsledger.session import new_run_id, run_session
from obsledger.sinks.publish import BUILD, publish, write_facts
from obsledger.sinks.reports import write_sample
from obsledger.sources.drops import DropSet, plan_drops
from obsledger.sources.headers import ReadHead, read_head
from obsledger.sources.manifest import listing_session, scan_drops, snapshot
from obsledger.sources.table import QUARANTINE_SCHEMA, Commit, FactTable, read_facts

log = logging.getLogger(__name__)

# Object stores keep whole seconds: a file that lands right after a listing may
# show the listing's own second. Reading it again is harmless, missing it is not.
LISTING_SLACK = dt.timedelta(seconds=1)


class EmptyListing(RuntimeError):
    """A build found no file at all."""


@dataclass
class RunResult:
    """What a build or update did."""

    commit: Commit
    drops: DropSet
    new_rows: int
    collapsed_rows: int

    def rejected_files(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.drops.rejected, QUARANTINE_SCHEMA)


def listing_mark(listed_at: dt.datetime | None) -> dt.datetime | None:
    """Watermark for a listing that began at ``listed_at``."""
    return None if listed_at is None else listed_at.replace(microsecond=0) - LISTING_SLACK


def bytes_of(manifest: DataFrame) -> int:
    """Bytes of the listed files; 0 where the list holds paths only."""
    if "length" not in manifest.columns:
        return 0
    return manifest.agg(F.sum("length")).first()[0] or 0


def set_aside(
    spark: SparkSession,
    table: FactTable,
    run_id: str,
    drops: DropSet,
    files: DataFrame | None = None,
) -> None:
    """Store the files that this run cannot read, with the reason, before it publishes.

    A run over ``files`` adds to the table: what could not be opened before and is
    not among them stays open, and is stored again.
    """
    kept = spark.createDataFrame(drops.rejected, QUARANTINE_SCHEMA)
    if files is not None:
        kept = kept.unionByName(table.unopened(spark).join(files.select("path"), "path", "left_anti"))
    table.set_aside(spark, run_id, kept)
    if drops.rejected:
        log.warning("%d files set aside in %s", len(drops.rejected), table.quarantine_path(run_id))


def to_retry(spark: SparkSession, table: FactTable) -> DataFrame:
    """Paths that could not be opened and have not been read since; a later run may."""
    return table.unopened(spark).select("path")


def metrics_of(drops: DropSet, observed: Observed, new_rows: int) -> dict[str, int]:
    counts = {f"{k}_files": v for k, v in drops.files_per_family().items()}
    return counts | {
        "rejected_files": len(drops.rejected),
        "new_rows": new_rows,
        **observed.counts(),
        **{f"{k}_date_files": v for k, v in observed.unclear.items()},
    }


def keep_left_out(
    spark: SparkSession,
    table: FactTable,
    run_id: str,
    drops: DropSet,
    observed: Observed,
    rules: Rules,
) -> None:
    """Store the rows that the writing pass left out. They are read again only if its counters say that there are any."""
    counts = observed.counts()
    left_out = counts[SHIFTED] + counts[UNDATED]
    if left_out:
        rows_left_out(spark, drops, rules).write.parquet(table.left_out_path(run_id))
        log.warning("%d rows left out, see %s", left_out, table.left_out_path(run_id))


def build_from(
    spark: SparkSession,
    manifest: DataFrame,
    table: FactTable,
    *,
    listed_at: dt.datetime | None,
    run_id: str | None = None,
    kind: str = BUILD,
    zones: dict[str, str] | None = None,
    rules: Rules = Rules(),
    opener: ReadHead = read_head,
    sample_path: str | None = None,
    sample_k: int = SAMPLE_K,
    sample_seed: int = SAMPLE_SEED,
    allow_empty: bool = False,
) -> RunResult:
    """Publish a version that holds exactly the drops of ``manifest``.

    A manifest without files is an error unless ``allow_empty``: a root that is
    misspelt or not mounted must not replace a full table by an empty one.
    """
    run_id = run_id or new_run_id()
    previous = table.commit(spark)
    drops = plan_drops(
        spark, manifest, zones=zones, opener=opener, quoted_breaks=not rules.multi_line
    )
    if not (drops.layouts or drops.rejected or allow_empty):
        raise EmptyListing("no drops are listed: nothing to build the table from")
    set_aside(spark, table, run_id, drops)
    observed = observe(run_session(spark, bytes_of(manifest)), drops, rules)
    segment = table.segment_path(run_id)
    write_facts(distinct_rows(observed.rows), segment)
    keep_left_out(spark, table, run_id, drops, observed, rules)
    rows = read_facts(spark, segment).count()
    commit = publish(
        spark,
        table,
        previous,
        run_id=run_id,
        kind=kind,
        segments=[run_id],
        listed_at=listing_mark(listed_at),
        published_at=dt.datetime.now(dt.timezone.utc),
        metrics=metrics_of(drops, observed, rows),
    )
    if sample_path is not None:
        facts = read_facts(spark, segment)
        write_sample(
            uniform_sample(facts, sample_k, seed=sample_seed, total_rows=rows), sample_path
        )
    return RunResult(commit, drops, rows, commit.metrics["collapsed_rows"])


def build(
    spark: SparkSession,
    root: str,
    table: FactTable,
    *,
    run_ts: dt.datetime,
    properties: list[str] | None = None,
    **options,
) -> RunResult:
    """List every drop of the properties below ``root`` and rebuild the table.

    ``run_ts`` must be taken before the call: it becomes the watermark.
    """
    run_id = options.pop("run_id", None) or new_run_id()
    manifest = snapshot(
        spark,
        scan_drops(listing_session(spark), root, properties),
        f"{table.staging_path(run_id)}/manifest",
    )
    return build_from(spark, manifest, table, listed_at=run_ts, run_id=run_id, **options)
