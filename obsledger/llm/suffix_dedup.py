"""Suffix-array dedup: repeated byte strings found by distributed prefix doubling.

The positions that are ranked are content-defined anchors (see ``anchors``), about
one for each 65 bytes, so that the table of (position, rank) rows is a fraction of the
text. Rank 1 names the phrase from an anchor to the next; each round pairs the
rank of a position with that of the position 2^r phrases on and names the
pairs anew. A position whose name is unique falls out, as does one whose
phrases reach past what every window of the threshold's length shares. Exact
windows of bytes around the positions left then decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from obsledger.llm.anchors import GRAM, anchors_of, phrase_hashes, width_for
from obsledger.llm.rolling import mix, running_sums, span_hashes
from obsledger.llm.tables import Scratch, add_columns, slices

LENGTH = 400
CELL = 32
"""Windows of an anchor are decided in cells of so many start offsets before they are taken one by one."""

ANCHORS = "_doc bigint, _v bigint, i int, at int, first int, last int, reach int, rank bigint, whole bigint"
CELLS = "_doc bigint, _v bigint, at int, lo int, hi int, mine boolean, core bigint, cell bigint"
WINDOWS = "_doc bigint, _v bigint, lo int, mine boolean, window bigint"
REMOVED = T.StructType(
    [
        T.StructField("kept", T.BinaryType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField(
            "spans",
            T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
        ),
    ]
)


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64), pa.int64())


def _raw(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _salt(h: np.ndarray, *numbers: np.ndarray) -> np.ndarray:
    for n in numbers:
        h = mix(h ^ (n.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    return h


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A document is known by 128 bits of its id and text, so rows of one id, or of none, stay apart."""
    return docs.select(*_key(id_col, text_col), F.col(text_col).alias("_text"))


def _key(id_col: str, text_col: str) -> list[Column]:
    return [F.xxhash64(id_col, text_col).alias("_doc"), F.xxhash64(text_col, F.lit(7)).alias("_v")]


def anchor_rows(keyed: DataFrame, length: int) -> DataFrame:
    """One row for each anchor: place, windows, phrases that its windows share, phrase name, name of its windows."""
    names = _names(ANCHORS)
    width = width_for(length)

    def run(batches):
        for batch in slices(batches):
            docs, vs, texts = (batch.column(i).to_pylist() for i in range(3))
            for doc, v, text in zip(docs, vs, texts, strict=True):
                sums = running_sums(_raw(text))
                found = anchors_of(sums, length, width)
                if found is None:
                    continue
                at, first, last = found
                m = len(at)
                own = first <= last
                # A window of this anchor starts less than a width before it, so anchors up to here
                # belong to it, whatever surrounds it: equal windows have equal reach.
                shared = np.searchsorted(at, at + length - GRAM - 2 * width + 2, "right") - 1
                reach = shared - np.arange(m)
                rank = np.append(phrase_hashes(sums, at), np.uint64(0))
                end = np.where(own, last + length, first)
                whole = _salt(span_hashes(sums, first, end), at - first, last - first)
                ints = [pa.array(x.astype(np.int32)) for x in (np.arange(m), at, first, last, reach)]
                fixed = [pa.array(np.full(m, doc, np.int64)), pa.array(np.full(m, v, np.int64))]
                arrays = [*fixed, *ints, _signed(rank), _signed(whole)]
                if m > 1:
                    yield pa.RecordBatch.from_arrays(arrays, names=names).slice(0, m - 1)

    return keyed.mapInArrow(run, ANCHORS)


def _repeated(rows: DataFrame, key: str, scratch: Scratch, name: str) -> DataFrame:
    """Rows whose key another row has too. Counted per task before the shuffle; the counts are
    written, so that each side of the join has an exchange of its own and Spark can split a hot key."""
    held = rows.groupBy(key).agg(F.count("*").alias("_held")).where("_held > 1").drop("_held")
    return rows.join(scratch.keep(held, f"{name}-{key}-held"), key)


def doubled(anchors: DataFrame, scratch: Scratch) -> DataFrame:
    """The anchors whose phrases, as far as its windows share them, are repeated, by prefix doubling."""
    rows, step = scratch.keep(_repeated(anchors, "rank", scratch, "1"), "rank-1"), 1
    done = rows.where("reach = 1")
    while rows.where(F.col("reach") >= 2 * step).limit(1).count():
        on = F.max("rank").over(
            Window.partitionBy("_doc", "_v").orderBy("i").rangeBetween(step, step)
        )
        # What reaches 2 x step phrases on is followed by what reaches step or more.
        paired = (
            rows.where(F.col("reach") >= step)
            .withColumn("_on", on)
            .where(F.col("_on").isNotNull() & (F.col("reach") >= 2 * step))
            .withColumn("rank", F.xxhash64("rank", "_on"))
            .drop("_on")
        )
        step *= 2
        rows = scratch.keep(_repeated(paired, "rank", scratch, str(step)), f"rank-{step}")
        done = done.unionByName(rows.where(F.col("reach").between(step, 2 * step - 1)))
    return done


def _marked(rows: DataFrame, key: str, place: list[str], scratch: Scratch) -> DataFrame:
    """Rows with ``_held``, how many have the key, and ``_lead``, true for one of them."""
    stats = rows.groupBy(key).agg(
        F.count("*").alias("_held"), F.min(F.struct(*place)).alias("_first")
    )
    stats = scratch.keep(stats.where("_held > 1"), f"{key}-stats")
    lead = F.coalesce(F.struct(*place) == F.col("_first"), F.lit(True))
    marked = rows.join(stats, key, "left").withColumn("_lead", lead).drop("_first")
    return marked.withColumn("_held", F.coalesce("_held", F.lit(1)))


def _beside_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The texts of the rows' documents, each with its rows as ``_rows``."""
    lists = rows.groupBy("_doc", "_v").agg(
        F.collect_list(F.struct("at", "lo", "hi", "mine")).alias("_rows")
    )
    return texts.join(lists, ["_doc", "_v"]).select("_doc", "_v", "_text", "_rows")


def _per_text(held: DataFrame, schema: str, spans) -> DataFrame:
    """Rows of ``schema`` from ``spans(sums, at, lo, hi, mine)`` of each text, its document in front."""
    names = _names(schema)

    def run(batches):
        for batch in slices(batches):
            docs, vs, texts = (batch.column(i).to_pylist() for i in range(3))
            lists = batch.column(3)
            for k, (doc, v, text) in enumerate(zip(docs, vs, texts, strict=True)):
                fields = lists[k].values
                at, lo, hi = (fields.field(i).to_numpy().astype(np.int64) for i in range(3))
                mine = fields.field(3).to_numpy(zero_copy_only=False)
                arrays = spans(running_sums(_raw(text)), at, lo, hi, mine)
                m = len(arrays[0])
                fixed = [pa.array(np.full(m, doc, np.int64)), pa.array(np.full(m, v, np.int64))]
                yield pa.RecordBatch.from_arrays([*fixed, *arrays], names=names)

    return held.mapInArrow(run, schema)


def _spread(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [begin, end], and the range of each."""
    sizes = end - begin + 1
    which = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[which], which


def _cells(length: int):
    def spans(sums, at, lo, hi, mine):
        cell, k = _spread((at - hi) // CELL, (at - lo) // CELL)
        at, lo, hi, mine = at[k], lo[k], hi[k], mine[k]
        lo, hi = np.maximum(lo, at - cell * CELL - CELL + 1), np.minimum(hi, at - cell * CELL)
        # Every window of the cell holds its core, in any document; the cell's own
        # windows together are the string from the first start to the last end.
        core_at = at - cell * CELL
        core = _salt(span_hashes(sums, core_at, core_at + length - CELL + 1), cell)
        whole = _salt(span_hashes(sums, lo, hi + length), at - lo, hi - lo)
        ints = [pa.array(x.astype(np.int32)) for x in (at, lo, hi)]
        return [*ints, pa.array(mine), _signed(core), _signed(whole)]

    return spans


def _windows(length: int):
    def spans(sums, at, lo, hi, mine):
        start, k = _spread(lo, hi)
        window = _salt(span_hashes(sums, start, start + length), at[k] - start)
        return [pa.array(start.astype(np.int32)), pa.array(mine[k]), _signed(window)]

    return spans


def repeated_spans(docs: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """(_doc, _v, lo, hi): spans of bytes that repeated strings of ``length`` bytes cover; they may overlap."""
    if length < CELL:
        raise ValueError(f"strings must have {CELL} bytes or more")
    scratch = Scratch(docs.sparkSession, "suffix")
    texts = _keyed(docs, id_col, text_col)
    anchors = scratch.keep(anchor_rows(texts, length), "anchors")
    places = doubled(anchors, scratch).where("first <= last")
    places = scratch.keep(_marked(places, "whole", ["_doc", "_v", "i"], scratch), "places")
    scratch.drop("anchors")
    span = lambda rows: rows.select("_doc", "_v", "lo", (F.col("hi") + length).alias("hi"))
    ranged = places.withColumnRenamed("first", "lo").withColumnRenamed("last", "hi")
    found = span(ranged.where("_held > 1"))

    # What stands alone as a whole may still share some of its windows, with others
    # of its kind or with one of those that are repeated as a whole.
    alone = ranged.where("_held = 1 or _lead").withColumn("mine", F.col("_held") == 1)
    held = scratch.keep(_beside_texts(alone, texts), "texts")
    cells = scratch.keep(_per_text(held, CELLS, _cells(length)), "cells")
    cells = scratch.keep(
        _marked(_repeated(cells, "core", scratch, "cells"), "cell", ["_doc", "_v", "at"], scratch), "marked-cells"
    )
    found = found.unionByName(span(cells.where("mine and _held > 1")))
    split = cells.where("mine and _held = 1")
    others = cells.where("(_held > 1 and _lead) or (_held = 1 and not mine)").withColumn("mine", F.lit(False))
    others = others.join(split.select("core").distinct(), "core", "left_semi")
    split = split.unionByName(others)
    single = _per_text(_beside_texts(split, held.drop("_rows")), WINDOWS, _windows(length))
    single = _repeated(scratch.keep(single, "windows"), "window", scratch, "windows").where("mine")
    return found.unionByName(span(single.withColumn("hi", F.col("lo"))))


def drop_repeated_strings(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with kept (bytes), n_bytes, n_removed and spans (start, end): what was removed.

    Removed is each UTF-8 byte that a string of ``length`` bytes covers which also starts somewhere
    else, in the same document or another; strings overlap, are judged on the input and do
    not cross documents. Names are 64-bit hashes of strings of one kind, and documents are told apart by
    128-bit hashes; no other step is inexact.

    Null and empty texts, and texts shorter than ``length``, lose nothing. Rows of one id and
    text are documents of their own and repeat each other. Rows without id are treated
    alike. Columns named as above are replaced, others pass through. An empty table gives no rows.
    """
    spans = (
        repeated_spans(docs, length, id_col, text_col)
        .groupBy("_doc", "_v")
        .agg(F.collect_set(F.struct("lo", "hi")).alias("_spans"))
    )
    one, two = _key(id_col, text_col)
    keyed = docs.withColumn("_one", one).withColumn("_two", two)
    joined = keyed.join(
        spans, (F.col("_one") == F.col("_doc")) & (F.col("_two") == F.col("_v")), "left"
    ).drop("_one", "_two", "_doc", "_v")

    def make():
        def columns(batch: pa.RecordBatch) -> list:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            lists = batch.column(batch.schema.get_field_index("_spans"))
            kept, sizes, removed, gone = [], [], [], []
            for k, text in enumerate(texts):
                raw = _raw(text)
                edges = np.zeros(len(raw) + 1, np.int64)
                if lists[k].is_valid:
                    pairs = lists[k].values
                    np.add.at(edges, pairs.field(0).to_numpy(), 1)
                    np.add.at(edges, pairs.field(1).to_numpy(), -1)
                out = np.cumsum(edges[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[0], out.view(np.int8), [0]])))
                kept.append(raw[~out].tobytes())
                sizes.append(len(raw))
                removed.append(int(out.sum()))
                gone.append([{"start": a, "end": b} for a, b in turns.reshape(-1, 2).tolist()])
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            return [
                pa.array(kept, pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(gone, spans_type),
            ]

        return columns

    return add_columns(joined, REMOVED, make).drop("_spans")
