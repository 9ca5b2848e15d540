"""Header probe: which column of each drop holds what.

A CSV read over many files binds columns by position, so files whose headers
differ must not share a read. The probe reads the first records of each file on
the executors, however long they are; files are then grouped by where the needed columns sit.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.schema import (
    PRIORITY_COLUMNS,
    PRIORITY_FAMILY,
    PRIORITY_REQUIRED,
    PROBE_BYTES,
    STANDBY,
    STANDBY_COLUMNS,
    STANDBY_REQUIRED,
)

HEADERED = "headered"
HEADERLESS = "headerless"
UNREADABLE = "unreadable"
PROBED = (
    "path string, family string, zone string, "
    "shape string, positions array<int>, width int, problem string"
)
FILES_PER_TASK = 256

ReadHead = Callable[[str, int], bytes]

# The probe is the only Python that runs on executors. Sent by value, it needs
# no copy of this package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_head(path: str, size: int) -> bytes:
    """First ``size`` bytes of a file on any store pyarrow can open."""
    from pyarrow import fs

    scheme, sep, rest = path.partition(":")
    if not sep or scheme == "file":
        store = fs.LocalFileSystem()
        target = "/" + (rest if sep else path).lstrip("/")
    else:
        store, target = fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))
    with store.open_input_stream(target) as stream:
        return stream.read(size)


def _records(head: bytes, limit: int, whole: bool = True) -> list[list[str]] | None:
    """The first records; None if ``head`` ends before they do and is not the ``whole`` file.

    A record is known to be complete once another one follows it.
    """
    text = head.decode("utf-8", errors="replace").removeprefix("﻿")
    rows: list[list[str]] = []
    for row in csv.reader(io.StringIO(text, newline="")):
        if row:
            rows.append(row)
        if len(rows) > limit:
            break
    return rows[:limit] if whole or len(rows) > limit else None


def _positions(names: list[str], wanted: list[str]) -> list[int]:
    """Position of each wanted column, -1 if absent; the first of twins counts."""
    return [names.index(w) if w in names else -1 for w in wanted]


Described = tuple[str | None, list[int], int, str | None]


def describe(family: str | None, head: bytes, whole: bool = True) -> Described | None:
    """Shape, column positions, field count and problem of one file.

    None asks for more bytes: the records that decide go on behind ``head``.
    """
    if family is None:
        return None, [], 0, "unknown family"
    try:
        rows = _records(head, 1 if family == STANDBY else 2, whole)
    except csv.Error:
        rows = [] if whole else None
    if rows is None:
        return None
    if not rows:
        return None, [], 0, "no header line"
    names = [n.strip() for n in rows[0]]
    if family == STANDBY:
        lower = [n.lower() for n in names]
        if not STANDBY_REQUIRED <= set(lower):
            return None, [], len(names), "missing columns"
        return HEADERED, _positions(lower, STANDBY_COLUMNS), len(names), None
    upper = [n.upper() for n in names]
    if PRIORITY_REQUIRED <= set(upper):
        return HEADERED, _positions(upper, PRIORITY_COLUMNS), len(names), None
    needed = len(PRIORITY_COLUMNS)
    if len(rows) > 1 and len(rows[1]) < needed:
        return None, [], len(rows[1]), "too few columns"
    return HEADERLESS, list(range(needed)), needed, None


def describe_file(family: str | None, path: str, opener: ReadHead) -> Described:
    """Read twice as much again until the deciding records are there, or the whole file is."""
    size = PROBE_BYTES
    while True:
        head = opener(path, size) if family else b""
        found = describe(family, head, whole=len(head) < size)
        if found is not None:
            return found
        size *= 2


def probe(files: DataFrame, opener: ReadHead = read_head) -> DataFrame:
    """Describe every file of a routed manifest (path, family, zone).

    Work is spread by file count. A file that cannot be opened is reported as a
    problem and does not stop the others.
    """

    def describe_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, family, zone in zip(batch["path"], batch["family"], batch["zone"]):
                try:
                    found = describe_file(family, path, opener)
                except (OSError, pa.ArrowException) as error:
                    found = (None, [], 0, f"{UNREADABLE}: {error}")
                out.append((path, family, zone, *found))
            yield pd.DataFrame(
                out,
                columns=["path", "family", "zone", "shape", "positions", "width", "problem"],
            )

    return files.select("path", "family", "zone").mapInPandas(describe_batches, PROBED)


def spread(files: DataFrame, count: int) -> DataFrame:
    """Partition a manifest so that a task probes a few hundred files."""
    return files.repartition(max(1, -(-count // FILES_PER_TASK)), F.col("path"))
