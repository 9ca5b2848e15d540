"""Incremental merge of changed drops into the table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from obsledger.operators.dedupe import distinct_rows
from obsledger.operators.merge import BROADCAST_BYTES, anti_join, measure
from obsledger.operators.sampling import uniform_sample
from obsledger.plans.build import (
    RunResult,
    build_from,
    bytes_of,
    keep_left_out,
    listing_mark,
    metrics_of,
    set_aside,
)
from obsledger.plans.observe import Rules, observe
from obsledger.schema import SAMPLE_K, SAMPLE_SEED
from obsledger.session import new_run_id, run_session
from obsledger.sinks.publish import UPDATE, publish, stage_facts, write_facts
from obsledger.sinks.reports import write_sample
from obsledger.sources.drops import plan_drops
from obsledger.sources.headers import ReadHead, read_head
from obsledger.sources.needs import read_needs, resolve_keys
from obsledger.sources.table import FactTable, read_facts


def update_from(
    spark: SparkSession,
    files: DataFrame,
    table: FactTable,
    *,
    listed_at: dt.datetime | None,
    run_id: str | None = None,
    zones: dict[str, str] | None = None,
    rules: Rules = Rules(),
    opener: ReadHead = read_head,
    sample_path: str | None = None,
    sample_k: int = SAMPLE_K,
    sample_seed: int = SAMPLE_SEED,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> RunResult | None:
    """Add the observations in ``files`` that the table does not hold yet.

    The distinct candidates are written once: that cuts the lineage, gives
    their exact size and time range, and lets the anti-join prune the table to
    that range. Only the rows that are new are written as a further segment;
    existing rows, own copies included, are neither read beyond the range nor
    rewritten. Returns None, with nothing written, if ``files`` is empty.

    ``listed_at`` is the time just before the listing that ``files`` comes from
    and becomes the watermark; None leaves the watermark where it was.
    """
    if files.isEmpty():
        return None
    run_id = run_id or new_run_id()
    previous = table.commit(spark)
    if previous is None:
        return build_from(
            spark,
            files,
            table,
            listed_at=listed_at,
            run_id=run_id,
            kind=UPDATE,
            zones=zones,
            rules=rules,
            opener=opener,
            sample_path=sample_path,
            sample_k=sample_k,
            sample_seed=sample_seed,
        )
    drops = plan_drops(spark, files, zones=zones, opener=opener, quoted_breaks=not rules.multi_line)
    set_aside(spark, table, run_id, drops, files)
    work = run_session(spark, bytes_of(files))
    observed = observe(work, drops, rules)
    staged = f"{table.staging_path(run_id)}/candidates"
    stage_facts(distinct_rows(observed.rows), staged)
    keep_left_out(spark, table, run_id, drops, observed, rules)
    candidates = read_facts(work, staged)
    extent = measure(candidates)

    segment = table.segment_path(run_id)
    new_rows = 0
    if extent.rows:
        fresh = anti_join(
            candidates,
            table.read(work),
            extent=extent,
            broadcast_bytes=broadcast_bytes,
        )
        if extent.bytes > broadcast_bytes:
            joined = f"{table.staging_path(run_id)}/fresh"
            stage_facts(fresh, joined)
            fresh = read_facts(work, joined)
        write_facts(fresh, segment)
        new_rows = read_facts(spark, segment).count()
    segments = previous.segments + ([run_id] if new_rows else [])
    commit = publish(
        spark,
        table,
        previous,
        run_id=run_id,
        kind=UPDATE,
        segments=segments,
        listed_at=listing_mark(listed_at) or previous.listed_at,
        published_at=dt.datetime.now(dt.timezone.utc),
        metrics=metrics_of(drops, observed, new_rows),
    )
    if sample_path is not None:
        added = read_facts(spark, segment) if new_rows else candidates.limit(0)
        write_sample(
            uniform_sample(added, sample_k, seed=sample_seed, total_rows=new_rows),
            sample_path,
        )
    return RunResult(commit, drops, new_rows, commit.metrics["collapsed_rows"])


def update(
    spark: SparkSession,
    needs_path: str,
    root: str,
    table: FactTable,
    *,
    listed_at: dt.datetime | None,
    **options,
) -> RunResult | None:
    """Update from a stored needs list; its relative keys lie below ``root``."""
    files = resolve_keys(read_needs(spark, needs_path), root).distinct()
    return update_from(spark, files, table, listed_at=listed_at, **options)
