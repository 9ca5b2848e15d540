"""Latest-observation report from the published table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsledger.operators.explore import latest_per_entity
from obsledger.plans.summaries import LATEST, summarize
from obsledger.sinks.reports import write_latest
from obsledger.sources.table import FactTable


def latest(
    spark: SparkSession,
    table: FactTable,
    out_path: str,
    *,
    needs: DataFrame | None = None,
    single_file: bool = True,
    incremental: bool = False,
) -> bool:
    """Write the report; False, with nothing written, if ``needs`` is empty.

    A table that was never published is an error; an empty one gives a report
    with a header only. ``incremental`` keeps the report's rows below the
    table's root and then reads only segments published since the last report.
    """
    if needs is not None and needs.isEmpty():
        return False
    if table.commit(spark) is None:
        raise FileNotFoundError(f"{table.root} was never published")
    found = summarize(spark, table, LATEST) if incremental else latest_per_entity(table.read(spark))
    write_latest(found, out_path, single_file=single_file)
    return True
