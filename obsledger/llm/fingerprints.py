"""Document fingerprints: MinHash signatures of word shingles, their likeness, and the pairs they find."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsledger.llm.jaccard import jaccard_pairs
from obsledger.llm.shingles import shingle_hashes, signature
from obsledger.llm.tables import add_columns, slices, texts_of

PERMUTATIONS = 128
WORDS = 5
RANGE_ROWS = 1024
MOST_RANGES = 50_000
"""``successors`` cuts the ids into ranges of about so many rows; beyond so many ranges
they hold more rows instead, which are streamed all the same."""
LEAST = -(1 << 63)
EDITS = T.StructType(
    [
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def fingerprint_of(text: str, words: int = WORDS, permutations: int = PERMUTATIONS) -> str:
    """Eight hexadecimal digits for each permutation; no shingles give all f."""
    return signature(shingle_hashes(text, words), permutations).astype(">u4").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal positions: estimates the Jaccard similarity of the shingle sets."""
    x, y = (np.frombuffer(bytes.fromhex(f), ">u4") for f in (a, b))
    return float((x == y).mean())


def fingerprints(
    docs: DataFrame, text_col: str = "text", words: int = WORDS, permutations: int = PERMUTATIONS
) -> DataFrame:
    """``docs`` with ``fingerprint``.

    Equal texts have equal fingerprints; a null text counts as empty, texts
    without words are all alike, and a text of fewer than ``words`` words is one shingle. A column
    ``fingerprint`` of the input is replaced, others pass through.
    """

    def make():
        def columns(batch: pa.RecordBatch) -> list:
            found = [fingerprint_of(t, words, permutations) for t in texts_of(batch, text_col)]
            return [pa.array(found, pa.string())]

        return columns

    return add_columns(docs, T.StructType([T.StructField("fingerprint", T.StringType())]), make)


def similar_pairs(docs: DataFrame, threshold: float = 0.8, **options) -> DataFrame:
    """Pairs of texts whose fingerprints share a band and whose true Jaccard similarity reaches ``threshold``.

    (a, b, similarity) between the first documents of equal shingle sets; see ``jaccard_pairs``.
    """
    return jaccard_pairs(docs, threshold=threshold, **options)


def successors(
    docs: DataFrame,
    id_col: str,
    columns: list[str],
    derive: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """``id_col`` and ``columns`` of each row, and as ``next_*`` those of the row that follows by id.

    ``derive`` may add columns, row by row and in order; they come out for both rows too.

    The first row follows the last; of equal ids the smaller values of the columns come
    first, and rows without id stand before all others. Rows are dealt to
    ranges of ids and streamed in order; only the first row of a range also goes to the
    range before, so each value moves once. The ranges are a fixed function of the id: a
    task that runs again sees the same rows. The driver holds two numbers for each range.
    """
    docs = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LEAST)).alias("_id"), id_col, *columns)
    rows = docs.count()
    parts = min(MOST_RANGES, max(1, rows // RANGE_ROWS))
    cuts = [i / parts for i in range(1, parts)]
    bounds = np.unique(docs.approxQuantile("_id", cuts, 0.1 / parts)).astype(np.int64) if cuts else np.empty(0, np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), "right").astype(np.int32))

    first = docs.groupBy(range_of("_id").alias("r")).agg(F.min("_id").alias("id")).collect()  # one row a range
    first = sorted((x["id"], x["r"]) for x in first)
    firsts = np.array([x for x, _ in first], np.int64)
    before = np.array([first[-1][1]] + [r for _, r in first[:-1]], np.int32) if first else np.empty(0, np.int32)

    @F.pandas_udf("int")
    def also_in(ids: pd.Series) -> pd.Series:
        ids = ids.to_numpy()
        at = np.minimum(np.searchsorted(firsts, ids), len(firsts) - 1)
        return pd.Series(np.where(firsts[at] == ids, before[at], -1).astype(np.int32))

    smallest = int(firsts[0]) if first else LEAST
    places = F.array(
        F.struct(F.col("_range").alias("r"), F.lit(False).alias("wrapped"), F.lit(True).alias("own")),
        F.struct(F.col("_also").alias("r"), (F.col("_id") == smallest).alias("wrapped"), F.lit(False).alias("own")),
    )
    ordered = (
        docs.withColumn("_range", range_of("_id"))
        .withColumn("_also", also_in("_id"))
        .withColumn("_place", F.explode(F.filter(places, lambda p: p["r"] >= 0)))
        .select("_place.*", "_id", id_col, *columns)
        .repartition("r")
        .sortWithinPartitions("r", "wrapped", "_id", *columns)
        .select("own", id_col, *columns)
    )
    ordered = derive(ordered)
    own, *given = ordered.schema.fields
    values = [f for f in given if f.name != id_col]
    schema = T.StructType([*given, *[T.StructField(f"next_{f.name}", f.dataType) for f in values]])
    names = schema.fieldNames()

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if held is not None and batch.num_rows:
                batch = pa.concat_batches([held, batch])
            if batch.num_rows:
                here, after = batch.slice(0, batch.num_rows - 1), batch.slice(1)
                following = [after.column(after.schema.get_field_index(f.name)) for f in values]
                out = pa.RecordBatch.from_arrays([*here.columns[1:], *following], names=names)
                yield out.filter(here.column(0))
                held = batch.slice(batch.num_rows - 1)

    return ordered.mapInArrow(shift, schema)


def fingerprint_edits(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    permutations: int = PERMUTATIONS,
) -> DataFrame:
    """How fingerprints follow an edit: each text against itself with the second half taken from the next one.

    The last floor(n/2) code points give way to the first as many (or all) of the text
    that follows by id. Gives id, n_chars, edited (the text), fingerprint, edited_fingerprint, near_edited and
    near_next (likeness to the edited text's and the next text's fingerprint). A null text counts as empty.
    """
    plain = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    followed = successors(
        plain, id_col, ["_text"], lambda df: fingerprints(df, "_text", words, permutations)
    )
    half = F.floor(F.char_length("_text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("_text"), F.lit(1), F.char_length("_text") - half),
        F.substring(F.col("next__text"), F.lit(1), half),
    )
    pairs = followed.select(
        id_col,
        F.char_length("_text").cast("bigint").alias("n_chars"),
        edited.alias("edited"),
        "fingerprint",
        "next_fingerprint",
    )

    def make():
        def columns(batch: pa.RecordBatch) -> list:
            own = batch.column(batch.schema.get_field_index("fingerprint")).to_pylist()
            after = batch.column(batch.schema.get_field_index("next_fingerprint")).to_pylist()
            new = [fingerprint_of(t, words, permutations) for t in texts_of(batch, "edited")]
            return [
                pa.array(new, pa.string()),
                pa.array(map(likeness, own, new), pa.float64()),
                pa.array(map(likeness, own, after), pa.float64()),
            ]

        return columns

    return add_columns(pairs, EDITS, make).drop("next_fingerprint")
