"""CSV records that run over lines, in files that stay splittable.

A line of a CSV file either begins inside a quoted field or it does not, and which of the two decides what it
leaves open at its end. So a line is one of four functions of a bit: it keeps the bit, turns
it, or sets it to 0 or 1. Functions are composed along the lines of each byte range first, then along the ranges of
each file, one row a range; after that every range knows how it starts, and its lines are put together to records
wherever they lie.
"""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obsledger.session import new_run_id, work_dir
from obsledger.sources.manifest import escape_glob

UNCLOSED = "unclosed quotes"
TOO_LONG = "quoted record too long"
MOST_BYTES = 16 << 20
"""A longer record is taken for the trace of a stray quote: its file is set aside."""

_BODY = '[^"]*+(?:""[^"]*+)*+'
_FIELD = f'(?:"{_BODY}"[^,]*+|[^",][^,]*+|)'
# A quote inside an unquoted field is an ordinary character, as is what follows a closing quote.
_OPENS = rf'\A(?:{_FIELD},)*+"{_BODY}\z'
_STAYS = rf'\A{_BODY}(?:"[^,]*+,(?:{_FIELD},)*+"{_BODY})?+\z'

RECORDS_AT_ONCE = 64
"""Sizes are summed over so many neighbouring records first; only where these are too long together, one by one."""

FILE, BLOCK, ORDER, GROUP = "file", "block", "file_order", "file_group"


def opens(line: Column) -> Column:
    """A line that begins outside quotes leaves a quoted field open."""
    return line.contains('"') & F.regexp_like(line, F.lit(_OPENS))


def stays(line: Column) -> Column:
    """A line that begins inside quotes leaves a quoted field open."""
    return ~line.contains('"') | F.regexp_like(line, F.lit(_STAYS))


def plain_path(url: str) -> str:
    """A path as it reads without the escapes of a URL and without the scheme of local files."""
    return re.sub(r"^(file:)?/+", "/", unquote(url))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text([escape_glob(p) for p in paths])


def broken_files(spark: SparkSession, paths: list[str]) -> set[str]:
    """Of the paths, those of files with a record over several lines.

    The files are read as text once; what comes to the driver is one path for each such file.
    """
    if not paths:
        return set()
    found = _lines(spark, paths).filter(opens(F.col("value"))).select("_metadata.file_path").distinct()
    held = {plain_path(r.file_path) for r in found.collect()}
    return {p for p, plain in listed_paths(paths) if plain in held}


def listed_paths(paths: list[str]) -> list[tuple[str, str]]:
    """Each listed path with its ``plain_path``, which undoes a URL's escapes; a listed path has none."""
    return [(p, plain_path(p.replace("%", "%25"))) for p in paths]


def _carried(df: DataFrame, by: list[str], order: str, zero: str, one: str, out: str) -> DataFrame:
    """Add ``out``0 and ``out``1: the bit before each row if its group starts with 0 and with 1.

    The bit after the last row that sets it, turned by every row since that turns it.
    """
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    turns = (F.col(zero) & ~F.col(one)).cast("bigint")
    sets = F.when(F.col(zero) == F.col(one), F.struct(F.col(zero).alias("bit"), F.sum(turns).over(upto).alias("turned")))
    df = df.withColumn("__set", sets).withColumn("__turns", F.coalesce(F.sum(turns).over(before), F.lit(0)))
    df = df.withColumn("__set", F.last("__set", ignorenulls=True).over(before))
    turned = (F.col("__turns") - F.coalesce("__set.turned", F.lit(0))) % 2 == 1
    for start in (0, 1):
        df = df.withColumn(f"{out}{start}", F.coalesce("__set.bit", F.lit(bool(start))) != turned)
    return df.drop("__set", "__turns")


class QuotedFiles:
    """Records of files of which some run over lines. The lines are written once, with what each range of
    bytes would make of them if it started inside and outside quotes, in a folder for each of ``groups`` of the files;
    so are the ranges. Whoever reads records of some of the files reads the folders that hold them."""

    def __init__(
        self, spark: SparkSession, paths: list[str], order: Column, groups: list[list[str]] | None = None
    ) -> None:
        self.spark, self.groups = spark, [g for g in groups or [paths] if g]
        frames = [
            _lines(spark, group).select(
                F.lit(k).alias(GROUP),
                F.col("_metadata.file_path").alias(FILE),
                F.col("_metadata.file_block_start").alias(BLOCK),
                order.alias(ORDER),
                "value",
            )
            for k, group in enumerate(self.groups)
        ]
        lines, by = reduce(DataFrame.unionByName, frames), [GROUP, FILE, BLOCK]
        lines = lines.withColumn("zero", opens(F.col("value"))).withColumn("one", stays(F.col("value")))
        lines = _carried(lines, by, ORDER, "zero", "one", "in")
        upto = Window.partitionBy(*by).orderBy(ORDER).rowsBetween(Window.unboundedPreceding, 0)
        for s in (0, 1):
            # A record begins at each line outside quotes that is not blank.
            begins = ~F.col(f"in{s}") & (F.trim("value", F.lit(" \t\r")) != "")
            lines = lines.withColumn(f"record{s}", F.sum(begins.cast("bigint")).over(upto))
            lines = lines.withColumn(f"after{s}", F.when(F.col(f"in{s}"), F.col("one")).otherwise(F.col("zero")))
        self.folder = f"{work_dir(spark)}/quoted-{new_run_id()}"
        lines = lines.drop("zero", "one")
        lines.write.partitionBy(GROUP).parquet(f"{self.folder}/lines")
        self.schema = lines.schema
        ranges = self._ranges()
        ranges.write.parquet(f"{self.folder}/ranges")
        # Stored, so that Spark knows how small they are and need not shuffle the lines to join them.
        self.ranges_schema = ranges.schema

    def _stored(self, spark: SparkSession, paths: list[str] | None) -> tuple[DataFrame, DataFrame]:
        """Lines and ranges, of all files or of ``paths``."""
        lines = spark.read.schema(self.schema).parquet(f"{self.folder}/lines")
        ranges = spark.read.schema(self.ranges_schema).parquet(f"{self.folder}/ranges")
        if paths is None:
            return lines, ranges
        wanted = set(paths)
        holding = [k for k, group in enumerate(self.groups) if not wanted.isdisjoint(group)]
        lines = lines.filter(F.col(GROUP).isin(holding))
        if {p for k in holding for p in self.groups[k]} <= wanted:
            return lines, ranges
        names = {plain for _, plain in listed_paths(paths)}
        urls = [r[0] for r in ranges.select(FILE).distinct().collect() if plain_path(r[0]) in names]
        return lines, ranges.filter(F.col(FILE).isin(urls))

    def _ranges(self) -> DataFrame:
        """One row for each range: whether it starts and ends inside quotes, and the record that its first lines go on with."""
        lines = self.spark.read.schema(self.schema).parquet(f"{self.folder}/lines")
        ranges = lines.groupBy(FILE, BLOCK).agg(
            F.max_by("after0", ORDER).alias("after0"),
            F.max_by("after1", ORDER).alias("after1"),
            F.max("record0").alias("record0"),
            F.max("record1").alias("record1"),
        )
        ranges = _carried(ranges, [FILE], BLOCK, "after0", "after1", "start")
        ranges = ranges.withColumn("inside", F.col("start0")).withColumn(
            "records", F.when(F.col("start0"), F.col("record1")).otherwise(F.col("record0"))
        )
        before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        own = F.when(F.col("records") > 0, F.struct(F.col(BLOCK).alias("block"), F.col("records").alias("record")))
        return ranges.select(
            FILE,
            BLOCK,
            "inside",
            F.when(F.col("inside"), F.col("after1")).otherwise(F.col("after0")).alias("open"),
            F.last(own, ignorenulls=True).over(before).alias("goes_on"),
        )

    def _placed(self, spark: SparkSession, paths: list[str] | None = None) -> DataFrame:
        """Lines with the place of their record: the range where it begins and its number there."""
        inside = F.col("inside")
        lines, ranges = self._stored(spark, paths)
        lines = lines.join(ranges, [FILE, BLOCK])
        record = F.when(inside, F.col("record1")).otherwise(F.col("record0"))
        blank = ~F.when(inside, F.col("in1")).otherwise(F.col("in0")) & (F.trim("value", F.lit(" \t\r")) == "")
        return lines.filter(~blank).select(
            FILE,
            ORDER,
            "value",
            F.when(record > 0, F.col(BLOCK)).otherwise(F.col("goes_on.block")).alias("begin"),
            F.when(record > 0, record).otherwise(F.col("goes_on.record")).alias("record"),
        )

    def _too_long(self, files: list[str] | None, *record: Column) -> set[str]:
        """Files with more than MOST_BYTES of lines in one place, which ``record`` tells from others."""
        placed = self._placed(self.spark)
        if files is not None:
            placed = placed.filter(F.col(FILE).isin(files))
        sizes = placed.groupBy(FILE, "begin", *record).agg(F.sum(F.octet_length("value") + 1).alias("bytes"))
        return {r[0] for r in sizes.filter(F.col("bytes") > MOST_BYTES).select(FILE).distinct().collect()}

    def problems(self) -> dict[str, str]:
        """Files that cannot be put together, with the reason."""
        _, ranges = self._stored(self.spark, None)
        last = ranges.groupBy(FILE).agg(F.max_by("open", BLOCK).alias("open")).filter("open")
        long = self._too_long(None, F.floor(F.col("record") / RECORDS_AT_ONCE).alias("records"))
        long = self._too_long(sorted(long), F.col("record")) if long else long
        found = {file: TOO_LONG for file in long} | {r[0]: UNCLOSED for r in last.select(FILE).collect()}
        return {plain_path(p): problem for p, problem in found.items()}

    def problems_listed(self) -> dict[str, str]:
        """Those of the listed paths (path -> reason) that have to be set aside."""
        found = self.problems()
        return {p: found[plain] for group in self.groups for p, plain in listed_paths(group) if plain in found}

    def records(self, spark: SparkSession | None = None, paths: list[str] | None = None) -> DataFrame:
        """(file, file_order, record): every record but the first of each file, its lines joined again."""
        held = self._placed(spark or self.spark, paths).groupBy(FILE, "begin", "record").agg(
            F.min(ORDER).alias(ORDER), F.array_sort(F.collect_list(F.struct(ORDER, "value"))).alias("lines")
        )
        joined = F.array_join(F.transform("lines", lambda x: x["value"]), "\n")
        return held.filter((F.col("begin") > 0) | (F.col("record") > 1)).select(
            FILE, ORDER, F.regexp_replace(joined, r"\r\z", "").alias("record")
        )


def problems_of(spark: SparkSession, paths: list[str], order: Column) -> dict[str, str]:
    """Of files with records over lines, those (path -> reason) that have to be set aside."""
    return QuotedFiles(spark, paths, order).problems_listed() if paths else {}
