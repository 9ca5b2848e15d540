"""Anti-join merge of new observations into an existing table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.operators.dedupe import distinct_rows
from obsledger.schema import KEYS

# Largest build side that may be broadcast, in bytes of its unsafe rows.
BROADCAST_BYTES = 64 << 20
# Ranges of a pruned read at most, and days looked at to find them.
RANGES = 64
MOST_DAYS = 20_000
# One unsafe row of the four columns, without its texts: null bits, four
# words, padding of the texts, key, and the hash relation's pointers.
ROW_BYTES = 120


@dataclass(frozen=True)
class Extent:
    """Exact size and key range of a set of observations."""

    rows: int
    bytes: int
    low: str | None
    high: str | None
    ranges: tuple[tuple[str, str], ...] = ()


def time_ranges(df: DataFrame) -> tuple[tuple[str, str], ...]:
    """At most RANGES ranges of time text that hold all rows, from the days that occur.

    Days are text, so an unreadable time has a range of its own and does not
    stretch that of the others. Days that follow one another share a range, as a filter of many
    ranges is slow where the time is computed: each range compares it twice. Of more ranges, neighbours
    are one; beyond MOST_DAYS different days (unreadable texts), nothing is said.
    """
    day = F.substring("observed_at", 1, 10)
    days = (
        df.where(F.col("observed_at").isNotNull())
        .groupBy(day.alias("day"))
        .agg(F.min("observed_at").alias("low"), F.max("observed_at").alias("high"))
        .limit(MOST_DAYS + 1)
        .collect()
    )
    if len(days) > MOST_DAYS:
        return ()
    days.sort()
    spans: list[list] = []
    for at, d in enumerate(days):
        if at and _day_after(days[at - 1].day) == d.day:
            spans[-1].append(d)
        else:
            spans.append([d])
    each = -(-len(spans) // RANGES) or 1
    runs = [sum(spans[i : i + each], []) for i in range(0, len(spans), each)]
    return tuple((run[0].low, max(d.high for d in run)) for run in runs)


def _day_after(day: str) -> str | None:
    try:
        return (dt.date.fromisoformat(day) + dt.timedelta(days=1)).isoformat()
    except (ValueError, OverflowError):
        return None


def measure(df: DataFrame) -> Extent:
    """Size and time ranges; run it on a stored table."""
    texts = F.octet_length("entity_code") + F.octet_length("observed_at") + F.octet_length(
        "wait_time_type"
    )
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(texts), F.lit(0)).alias("text_bytes"),
        F.min("observed_at").alias("low"),
        F.max("observed_at").alias("high"),
    ).first()
    size = row.rows * ROW_BYTES + row.text_bytes
    return Extent(row.rows, size, row.low, row.high, time_ranges(df))


def within(existing: DataFrame, extent: Extent) -> DataFrame:
    """Existing rows whose time text lies in one of the extent's ranges.

    Equal keys have equal time texts, so nothing that could match is lost; the
    comparisons reach the Parquet scan and skip files, row groups and pages.
    """
    if extent.rows == 0:
        return existing.filter(F.lit(False))
    if extent.ranges:
        held = [F.col("observed_at").between(low, high) for low, high in extent.ranges]
        return existing.filter(reduce(lambda a, b: a | b, held))
    return existing.filter(F.col("observed_at").between(extent.low, extent.high))


def anti_join(
    candidates: DataFrame,
    existing: DataFrame,
    *,
    keys: list[str] | None = None,
    extent: Extent | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Candidates whose key is not in ``existing``; ``candidates`` must be distinct.

    With a measured ``extent`` below the limit, the candidates are broadcast
    and the existing table is scanned in place, without a shuffle: the rows it
    shares with the candidates form a subset of them, so they fit the same
    bound. Otherwise both sides shuffle once on the key; the existing side is
    made distinct first, so a key with many copies shrinks before it travels.
    Spark must not choose for itself there: it goes by the bytes of the files, and sorted
    zstd Parquet of a few MB unpacks to gigabytes of a broadcast's hash table.
    """
    names = KEYS if keys is None else keys
    base = existing if extent is None else within(existing, extent)
    base = base.select(*names)
    if extent is not None and extent.bytes <= broadcast_bytes:
        shared = base.join(F.broadcast(candidates.select(*names)), names, "left_semi")
        return candidates.join(F.broadcast(shared.distinct()), names, "left_anti")
    return candidates.join(base.distinct().hint("merge"), names, "left_anti")


def merge(
    existing: DataFrame, candidates: DataFrame, *, extent: Extent | None = None
) -> DataFrame:
    """Existing rows as they are, plus distinct candidates not among them."""
    fresh = distinct_rows(candidates)
    return existing.select(*KEYS).unionByName(anti_join(fresh, existing, extent=extent))
