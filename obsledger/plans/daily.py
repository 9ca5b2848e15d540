"""The daily chain: list, plan, merge, report, in one Spark application."""

from __future__ import annotations

import datetime as dt
import logging
import time
from dataclasses import dataclass

from pyspark.sql import SparkSession

from obsledger.functions.timestamps import report_zone, run_stamp
from obsledger.plans.build import RunResult, to_retry
from obsledger.plans.latest import latest
from obsledger.plans.report import Freshness, freshness, watermark_of
from obsledger.plans.update import update_from
from obsledger.schema import DAYS_BACK
from obsledger.session import new_run_id
from obsledger.sinks.reports import write_needs
from obsledger.sources.manifest import listing_session, scan_drops, snapshot
from obsledger.sources.needs import RUN_PREFIX
from obsledger.sources.table import FactTable

log = logging.getLogger(__name__)


@dataclass
class DailyResult:
    report: Freshness
    needs_path: str
    update: RunResult | None
    latest_written: bool
    elapsed_seconds: float


def run_daily(
    spark: SparkSession,
    root: str,
    table: FactTable,
    out_dir: str,
    *,
    run_ts: dt.datetime | None = None,
    properties: list[str] | None = None,
    zone: str | None = None,
    days_back: int = DAYS_BACK,
    **options,
) -> DailyResult:
    """Run the three steps in order; the first failure stops the chain.

    ``run_ts`` is taken before the listing and becomes the next watermark. The
    files are listed once and every step works from that stored listing.
    """
    started = time.perf_counter()
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc)
    run_id = new_run_id()
    zone = zone or report_zone()
    out_dir = out_dir.rstrip("/")

    manifest = snapshot(
        spark,
        scan_drops(listing_session(spark), root, properties),
        f"{table.staging_path(run_id)}/manifest",
    )
    report = freshness(
        manifest, watermark_of(spark, table), run_ts, zone=zone, days_back=days_back
    )
    needs_path = f"{out_dir}/{RUN_PREFIX}{run_stamp(run_ts)}.csv"
    write_needs(report.needs, needs_path, zone)

    # Files that the last run could not open lie behind its watermark: read them again.
    again = manifest.join(to_retry(spark, table), "path", "left_semi")
    files = report.needs.unionByName(again).distinct()
    done = update_from(spark, files, table, listed_at=run_ts, run_id=run_id, **options)
    report_path = f"{out_dir}/latest_obs_report.csv"
    written = done is not None and latest(spark, table, report_path, incremental=True)
    elapsed = time.perf_counter() - started
    log.info("daily run finished in %.1f min", elapsed / 60)
    return DailyResult(report, needs_path, done, written, elapsed)
