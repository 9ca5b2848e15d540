"""CSV scans of the drops: one read per group of files with equal layout."""

from __future__ import annotations

import os
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsledger.schema import PRIORITY_COLUMNS, STANDBY, STANDBY_COLUMNS
from obsledger.session import size_of
from obsledger.sources.headers import (
    HEADERED,
    ReadHead,
    probe,
    read_head,
    spread,
)
from obsledger.sources.manifest import escape_glob, route, with_zone, zone_dimension
from obsledger.sources.quoted import QuotedFiles, broken_files

EXTRA_FIELD = "extra_field"
FILE = "file"
FILE_ORDER = "file_order"


@dataclass(frozen=True)
class Layout:
    """What files that may share one CSV read have in common."""

    family: str
    zone: str
    shape: str
    positions: tuple[int, ...]
    width: int
    day_first: bool = False


@dataclass
class DropSet:
    """Files to read by layout, those of them whose records run over lines, and the files set aside with their reason.

    ``quoted`` holds the lines of the files of ``broken``, written once for all scans of them.
    """

    layouts: dict[Layout, list[str]]
    rejected: list[tuple[str, str]]
    broken: set[str] = field(default_factory=set)
    quoted: QuotedFiles | None = None

    def parts(self) -> Iterator[tuple[Layout, list[str], bool]]:
        """Layout, files, and whether their records run over lines."""
        for layout, paths in self.layouts.items():
            for broken in (False, True):
                if some := [p for p in paths if (p in self.broken) == broken]:
                    yield layout, some, broken

    def shared_folder(self) -> str:
        return shared_folder(p for paths in self.layouts.values() for p in paths)

    def files_per_family(self) -> dict[str, int]:
        counts: dict[str, int] = defaultdict(int)
        for layout, paths in self.layouts.items():
            counts[layout.family] += len(paths)
        return dict(counts)


def plan_drops(
    spark: SparkSession,
    manifest: DataFrame,
    *,
    zones: dict[str, str] | None = None,
    opener: ReadHead = read_head,
    quoted_breaks: bool = True,
) -> DropSet:
    """Probe the listed files and group them by layout and zone.

    ``quoted_breaks`` reads the files once as text to find those with quoted line breaks, and sets aside those whose
    quotes do not close; without it such files must be read with ``multi_line``.

    What reaches the driver is one short row per file, never a row of data: the
    list of paths that Spark's own file index for the read holds there anyway.
    A file that cannot be opened, or whose store pyarrow does not know, is set
    aside with the reason; ``opener`` may read from other stores.
    """
    files = with_zone(route(manifest), zone_dimension(spark, zones))
    probed = probe(spread(files, manifest.count()), opener)
    layouts: dict[Layout, list[str]] = defaultdict(list)
    rejected: list[tuple[str, str]] = []
    for row in probed.collect():
        if row.problem is not None:
            rejected.append((row.path, row.problem))
            continue
        key = Layout(row.family, row.zone, row.shape, tuple(row.positions), row.width)
        layouts[key].append(row.path)
    drops = DropSet(dict(layouts), rejected)
    if quoted_breaks:
        drops.broken = broken_files(spark, [p for paths in layouts.values() for p in paths])
        problems: dict[str, str] = {}
        if drops.broken:
            groups = [[p for p in paths if p in drops.broken] for paths in layouts.values()]
            drops.quoted = QuotedFiles(spark, sorted(drops.broken), _order_in_file(spark), groups)
            problems = drops.quoted.problems_listed()
        drops.rejected += sorted(problems.items())
        drops.broken -= set(problems)
        kept = {k: [p for p in paths if p not in problems] for k, paths in layouts.items()}
        drops.layouts = {k: paths for k, paths in kept.items() if paths}
    return drops


def shared_folder(paths: Iterable[str]) -> str:
    """The folder that all of these files lie below; empty if there is none to cut."""
    shared = os.path.commonprefix(list(paths))
    shared = shared[: shared.rfind("/") + 1]
    return shared if quote(shared, safe="/:@") == shared else ""


def _shorten(path_column, shared: str):
    """Cut the folder all files of the drop set share; what is left still tells files apart.

    It must be the same folder for every layout: files of one name in different
    folders and layouts would otherwise become one.
    """
    if not shared:
        return path_column
    return F.when(
        path_column.startswith(shared), F.substring(path_column, len(shared) + 1, 1 << 20)
    ).otherwise(path_column)


def _order_in_file(spark: SparkSession):
    """One bigint that grows along each file, over all its splits.

    ``monotonically_increasing_id`` grows inside a partition (low 33 bits); the
    split's start byte orders the splits. Starts of one file lie at least the
    smallest split size apart, so dividing by it keeps them distinct and leaves
    30 bits, enough for files of millions of gigabytes at default settings. A
    bigint, unlike a struct, lets ``max_by`` run as a hash aggregate.
    """
    step = min(
        size_of(spark.conf.get("spark.sql.files.maxPartitionBytes")),
        size_of(spark.conf.get("spark.sql.files.openCostInBytes")),
    )
    split = F.floor(F.col("_metadata.file_block_start") / F.lit(max(1, step)))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.shiftleft(split, 33).bitwiseOR(row)


def _schema(layout: Layout) -> T.StructType:
    names = [f"c{i}" for i in range(layout.width)] + [EXTRA_FIELD] * (layout.shape == HEADERED)
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


CSV_OPTIONS = {"escape": '"', "mode": "PERMISSIVE"}


def _quoted_rows(
    spark: SparkSession, layout: Layout, paths: list[str], quoted: QuotedFiles | None
) -> DataFrame:
    """Fields of the records of files with quoted line breaks, with FILE and FILE_ORDER."""
    quoted = quoted or QuotedFiles(spark, paths, _order_in_file(spark))
    records = quoted.records(spark, paths)
    columns = ", ".join(f"{name} string" for name in _schema(layout).fieldNames())
    fields = F.from_csv("record", columns, CSV_OPTIONS)
    return records.select(FILE, FILE_ORDER, fields.alias("__fields")).select(FILE, FILE_ORDER, "__fields.*")


def scan_layout(
    spark: SparkSession,
    layout: Layout,
    paths: list[str],
    *,
    ordered: bool = False,
    multi_line: bool = False,
    ignore_missing: bool = False,
    broken: bool = False,
    quoted: QuotedFiles | None = None,
    shared: str = "",
) -> DataFrame:
    """Read the files of one layout as all-string columns by canonical name.

    Line 1 of each file is dropped and columns bind by position. Headered files
    get one more field than their header names, EXTRA_FIELD: a value there means that the row is
    shifted. Undecodable bytes become U+FFFD. Unneeded columns are pruned by the parser.
    ``broken``: records of these files may run over lines; ``quoted`` has their lines if they are written already.
    """
    if broken and not multi_line:
        df = _quoted_rows(spark, layout, paths, quoted)
        path, order = F.col(FILE), F.col(FILE_ORDER)
    else:
        df = (
            spark.read.schema(_schema(layout))
            .options(header=True, encoding="UTF-8", **CSV_OPTIONS)
            .option("multiLine", multi_line)
            .option("ignoreMissingFiles", ignore_missing)
            .csv([escape_glob(p) for p in paths])
        )
        path, order = F.col("_metadata.file_path"), _order_in_file(spark)
    wanted = STANDBY_COLUMNS if layout.family == STANDBY else PRIORITY_COLUMNS
    columns = [
        (F.col(f"c{at}") if at >= 0 else F.lit(None).cast("string")).alias(name)
        for name, at in zip(wanted, layout.positions)
    ]
    if ordered:
        columns += [_shorten(path, shared).alias(FILE), order.alias(FILE_ORDER)]
    return df.select(*columns, *[EXTRA_FIELD] * (layout.shape == HEADERED))


def is_shifted(df: DataFrame) -> Column:
    """Rows with more fields than their header."""
    return F.col(EXTRA_FIELD).isNotNull() if EXTRA_FIELD in df.columns else F.lit(False)
