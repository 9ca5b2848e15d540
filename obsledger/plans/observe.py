"""Drops -> observations: the part that build and update share."""

from __future__ import annotations

from collections import Counter
import logging
from dataclasses import dataclass, field, replace
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obsledger.functions.text import strip
from obsledger.operators.day_order import AMBIGUOUS, DAY_FIRST, MIXED, MONTH_FIRST, day_orders
from obsledger.operators.priority import (
    DOCUMENTED,
    collapse_priority,
    finish_priority,
    parse_priority,
    readable,
)
from obsledger.operators.standby import normalize_standby
from obsledger.schema import FACT_SCHEMA, STANDBY
from obsledger.sources.drops import (
    EXTRA_FIELD,
    FILE,
    FILE_ORDER,
    DropSet,
    Layout,
    is_shifted,
    scan_layout,
)
from obsledger.sources.quoted import listed_paths, plain_path

log = logging.getLogger(__name__)

INFER = "infer"


@dataclass(frozen=True)
class Rules:
    """Switches of the normalisers and the CSV scans.

    ``day_order``: ``month_first``, ``day_first`` or ``infer``, which reads the times of the standby files once
    more and decides file by file.
    """

    sellout: str = DOCUMENTED
    fold: str = "earlier"
    multi_line: bool = False
    ignore_missing: bool = False
    day_order: str = MONTH_FIRST

    def __post_init__(self) -> None:
        if self.day_order not in (MONTH_FIRST, DAY_FIRST, INFER):
            raise ValueError(f"unknown day order: {self.day_order}")


COLLAPSED, SHIFTED, UNDATED = "collapsed_rows", "shifted_rows", "undated_rows"


@dataclass
class Observed:
    """Observations of a drop set (not yet distinct) and the counters of their scan."""

    rows: DataFrame
    counters: list[Observation] = field(default_factory=list)
    unclear: dict[str, int] = field(default_factory=dict)
    """Files whose dates leave the order of day and month open, by kind; only where it was inferred."""

    def counts(self) -> dict[str, int]:
        """Rows dropped by keep-last and rows left out, by reason; valid once ``rows`` has been written."""
        total = Counter({COLLAPSED: 0, SHIFTED: 0, UNDATED: 0})
        for watch in self.counters:
            total.update(_counted(watch))
        return dict(total)


def _counted(watch: Observation) -> dict[str, int]:
    """Values of a counter; where no row arrived, Spark prunes it from the plan."""
    try:
        return {k: v or 0 for k, v in watch.get.items()}
    except Py4JJavaError as error:
        if "toPyRow" not in str(error):  # an empty row of counters cannot be turned into Python
            raise
        return {}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def file_day_orders(spark: SparkSession, drops: DropSet, rules: Rules = Rules()) -> DataFrame:
    """(file, dates, day_order) of the standby files with numeric dates, see ``day_orders``; only their times are read."""
    frames = [spark.createDataFrame([], f"{FILE} string, text string")]
    for layout, paths, broken in drops.parts():
        if layout.family == STANDBY:
            raw = scan_layout(spark, layout, paths, ordered=True, broken=broken, quoted=drops.quoted, **_scan_options(rules))
            times = raw.filter(~is_shifted(raw)).select(FILE, strip(F.col("observed_at")).alias("text"))
            frames.append(times)
    return day_orders(_union(frames), FILE, "text")


def with_day_orders(spark: SparkSession, drops: DropSet, rules: Rules) -> tuple[DropSet, dict[str, int]]:
    """``drops`` with files that give the day first in layouts of their own, and the number of files left open.

    Such files are read month first. The driver gets a row for each file that is not plainly month first.
    """
    if rules.day_order == MONTH_FIRST:
        return drops, {}
    if rules.day_order == DAY_FIRST:
        turned = {replace(k, day_first=k.family == STANDBY): v for k, v in drops.layouts.items()}
        return replace(drops, layouts=turned), {}
    found = file_day_orders(spark, drops, rules).filter(F.col("day_order") != MONTH_FIRST)
    held = {plain_path(r[FILE]): r.day_order for r in found.select(FILE, "day_order").collect()}
    layouts: dict[Layout, list[str]] = {}
    for layout, paths in drops.layouts.items():
        for path, plain in listed_paths(paths):
            day_first = layout.family == STANDBY and held.get(plain) == DAY_FIRST
            layouts.setdefault(replace(layout, day_first=day_first), []).append(path)
    counts = Counter(held.values())
    unclear = {AMBIGUOUS: counts[AMBIGUOUS], MIXED: counts[MIXED]}
    if any(unclear.values()):
        log.warning("order of day and month left open: %s files; read month first", unclear)
    return replace(drops, layouts=layouts), unclear


def observe(spark: SparkSession, drops: DropSet, rules: Rules = Rules()) -> Observed:
    """One plan over all layouts; the zone of each scan is a literal.

    Standby rows need no shuffle here. Priority rows of one zone share a single
    keep-last shuffle, keyed by file, entity and time.
    """

    drops, unclear = with_day_orders(spark, drops, rules)
    shared = drops.shared_folder()
    counters: list[Observation] = []

    def counted(df: DataFrame, **values: Column) -> DataFrame:
        counters.append(Observation())
        return df.observe(counters[-1], *[v.alias(k) for k, v in values.items()])

    def scan(layout: Layout, paths: list[str], broken: bool) -> DataFrame:
        raw = scan_layout(
            spark,
            layout,
            paths,
            shared=shared,
            ordered=layout.family != STANDBY or rules.fold == "infer",
            broken=broken,
            quoted=drops.quoted,
            **_scan_options(rules),
        )
        if EXTRA_FIELD not in raw.columns:
            return raw
        raw = counted(raw, **{SHIFTED: F.count_if(is_shifted(raw))})
        return raw.filter(~is_shifted(raw)).drop(EXTRA_FIELD)

    frames: list[DataFrame] = []
    by_zone: dict[str, list[DataFrame]] = {}
    for layout, paths, broken in drops.parts():
        raw = scan(layout, paths, broken)
        if layout.family == STANDBY:
            frames.append(
                normalize_standby(raw, layout.zone, fold=rules.fold, day_first=layout.day_first)
            )
        else:
            # Undated are those that come in and do not come out.
            parsed = parse_priority(counted(raw, **{UNDATED: F.count("*")}), sellout=rules.sellout)
            by_zone.setdefault(layout.zone, []).append(counted(parsed, **{UNDATED: -F.count("*")}))

    for zone, parsed in by_zone.items():
        kept = counted(collapse_priority(_union(parsed)), **{COLLAPSED: F.sum(F.col("source_rows") - 1)})
        frames.append(finish_priority(kept, zone, fold=rules.fold))

    if not frames:
        return Observed(spark.createDataFrame([], FACT_SCHEMA))
    return Observed(_union(frames), counters, unclear)


def _scan_options(rules: Rules) -> dict[str, bool]:
    return {"multi_line": rules.multi_line, "ignore_missing": rules.ignore_missing}


LEFT_OUT = "file string, family string, reason string, fields string"


def rows_left_out(spark: SparkSession, drops: DropSet, rules: Rules = Rules()) -> DataFrame:
    """(file, family, reason, fields) of the rows that the run left out, read as the run read them.

    Shifted rows hold more fields than their header; of undated ones entity or date cannot be read.
    """
    frames = [spark.createDataFrame([], LEFT_OUT)]
    for layout, paths, broken in drops.parts():
        raw = scan_layout(spark, layout, paths, ordered=True, broken=broken, quoted=drops.quoted, **_scan_options(rules))
        reason = F.when(is_shifted(raw), SHIFTED)
        if layout.family != STANDBY:
            reason = F.coalesce(reason, F.when(~readable(), UNDATED))
        fields = F.to_json(F.struct(*[c for c in raw.columns if c not in (FILE, FILE_ORDER)]))
        found = raw.select(F.col(FILE), F.lit(layout.family).alias("family"), reason.alias("reason"), fields.alias("fields"))
        frames.append(found.filter(F.col("reason").isNotNull()))
    return _union(frames)
