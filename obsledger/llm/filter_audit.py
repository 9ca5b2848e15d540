"""Filter interaction audit: what each filter of a set removes in every order of the set.

Words are counted in a sparse document-term matrix. Tasks cut the documents into shards and count with word
numbers of the shard's own; the shards' word lists are then numbered by a dictionary of all words, and the
shards take over its numbers, in compressed sparse rows (CSR). Only word lists are shuffled by
word, never (document, word) entries. Row sums and nonzero counts decide the filters on words, the
others are attached. Documents with the same failures, outcome and part are then counted as one.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obsledger.llm.tables import Scratch, slices

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT = 80
MOST_CAPITALS = 10
SYMBOLS = "#$%&*|"
SHARD_BITS = 40
"""A task numbers its shards in so many bits, below the number of its partition."""
BUCKETS = 1 << 14
"""Words are numbered in so many groups by hash; their sizes are all that must be known of other groups."""

FIELDS = ["doc", "part", "a", "b", "flags"]
ROW = "struct<doc: bigint, part: string, a: bigint, b: bigint, flags: int>"
ARRAYS = ["shard", "rows", "indptr", "indices", "data"]
CSR = f"shard bigint, rows array<{ROW}>, indptr binary, indices binary, data binary"
"""Matrix rows and the three arrays, packed as little-endian integers: 64-bit (``data``, and ``indices`` of a local shard, 32-bit)."""
COUNTED = "doc bigint, part string, a bigint, b bigint, flags int, n_words bigint, n_distinct bigint"


def _columns(batch: pa.RecordBatch, names: list[str]) -> dict[str, pa.Array]:
    return {n: batch.column(batch.schema.get_field_index(n)) for n in names}


def _one(values: pa.Array) -> pa.ListArray:
    """A column of one row that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packed(values: np.ndarray, kind: str = "<i8") -> pa.Array:
    return pa.array([values.astype(kind).tobytes()], pa.binary())


def _counted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """indptr, indices, data of the texts' words (numbered by first place) and the words."""
    # White space of ASCII is what parts words, the bytes of other characters belong to them.
    split = pc.ascii_split_whitespace(texts)
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    words = split.flatten()
    doc = np.repeat(np.arange(len(texts)), lengths)
    solid = pc.not_equal(words, "")  # white space at an end leaves an empty piece
    doc, coded = doc[solid.to_numpy(zero_copy_only=False)], words.filter(solid).dictionary_encode()
    width = max(len(coded.dictionary), 1)
    entries, data = np.unique(doc * width + coded.indices.to_numpy(), return_counts=True)
    return np.searchsorted(entries, np.arange(len(texts) + 1) * width), entries % width, data, coded.dictionary


def _flags(texts: pa.Array) -> np.ndarray:
    """Bits of the filters on characters."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
    capitals = np.flatnonzero((raw >= ord("A")) & (raw <= ord("Z")))
    capitals = np.diff(np.searchsorted(capitals, ends - ends[0]))
    shouts = 100 * capitals > MOST_CAPITALS * pc.utf8_length(texts).to_numpy().astype(np.int64)
    symbols = pc.match_substring_regex(texts, f"[{SYMBOLS}]").to_numpy(zero_copy_only=False)
    return shouts * (1 << FILTERS.index("C")) + symbols * (1 << FILTERS.index("D"))


def local_shards(docs: DataFrame) -> DataFrame:
    """Shards of ``docs`` (doc, part, a, b, text): CSR in the shard's own word numbers, and its words."""

    def run(batches):
        first = TaskContext.get().partitionId() << SHARD_BITS
        for k, piece in enumerate(slices(batches)):
            at = _columns(piece, [*FIELDS[:-1], "text"])
            texts = at["text"].cast(pa.string())
            at["flags"] = pa.array(_flags(texts).astype(np.int32))
            rows = pa.StructArray.from_arrays([at[n] for n in FIELDS], names=FIELDS)
            indptr, indices, data, words = _counted(texts)
            arrays = [pa.array([first + k], pa.int64()), _one(rows)]
            arrays += [_packed(indptr), _packed(indices, "<i4"), _packed(data, "<i4"), _one(words)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*ARRAYS, "words"])

    return docs.mapInArrow(run, f"{CSR}, words array<string>")


def _ranked(words: DataFrame) -> DataFrame:
    """``words`` with ``bucket`` and ``rank``: the number of the word in its bucket, from 1 without gaps."""
    hashed = words.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(BUCKETS)))
    return hashed.withColumn("rank", F.dense_rank().over(Window.partitionBy("bucket").orderBy("word")))


def _renumbered(local: pa.Table, numbers: pa.Table) -> pa.Table:
    """One local shard with the numbers of the dictionary in place of its own."""
    table = np.zeros(len(numbers), np.int64)
    table[numbers["own"].to_numpy()] = numbers["number"].to_numpy()
    renamed = table[np.frombuffer(local["indices"][0].as_py(), "<i4")]
    return local.select(ARRAYS).set_column(ARRAYS.index("indices"), "indices", _packed(renamed))


def _row_counts(shard: pa.Table) -> pa.Table:
    indptr, data = (np.frombuffer(shard[n][0].as_py(), kind) for n, kind in (("indptr", "<i8"), ("data", "<i4")))
    sums = np.concatenate([[0], np.cumsum(data.astype(np.int64))])[indptr]
    rows = shard["rows"][0].values
    arrays = [*(rows.field(n) for n in FIELDS), pa.array(np.diff(sums)), pa.array(np.diff(indptr))]
    return pa.table(arrays, names=[*FIELDS, "n_words", "n_distinct"])


class TermMatrix:
    """The document-term matrix of ``docs`` (doc, part, a, b, text); words are numbered from 0 without gaps."""

    def __init__(self, docs: DataFrame, scratch: Scratch) -> None:
        self._local = scratch.keep(local_shards(docs), "local")
        ranked = _ranked(self._local.select("shard", F.posexplode("words").alias("own", "word"))).drop("word")
        ranked = scratch.keep(ranked, "ranked")
        sizes = ranked.groupBy("bucket").agg(F.max("rank").alias("size"))  # at most BUCKETS rows
        before = F.sum("size").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
        self._first = scratch.keep(sizes.select("bucket", F.coalesce(before, F.lit(0)).alias("first")), "first")
        # A shard meets the numbers of its words: at most as many as it has bytes.
        self._numbered = self._local.drop("words").groupBy("shard").cogroup(
            self._number(ranked, "shard", "own").groupBy("shard")
        )

    def _number(self, ranked: DataFrame, *columns: str) -> DataFrame:
        number = (F.col("first") + F.col("rank") - 1).alias("number")
        return ranked.join(F.broadcast(self._first), "bucket").select(*columns, number)

    def dictionary(self) -> DataFrame:
        """(word, number) of every word."""
        return self._number(_ranked(self._local.select(F.explode("words").alias("word")).distinct()), "word")

    def shards(self) -> DataFrame:
        """The matrix in CSR shards, each with its matrix rows as ``rows``."""
        return self._numbered.applyInArrow(_renumbered, CSR)

    def row_counts(self) -> DataFrame:
        """The matrix rows with n_words, the sum of the row, and n_distinct, its nonzero entries."""
        return self._numbered.applyInArrow(lambda local, numbers: _row_counts(_renumbered(local, numbers)), COUNTED)


def _bit(failure: Column, letter: str) -> Column:
    return F.when(failure, 1 << FILTERS.index(letter)).otherwise(0)


def failures(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    scratch: Scratch | None = None,
) -> DataFrame:
    """(doc, part, failed, n_words, n_distinct): one row for each document, ``failed`` a bit for each filter, A the lowest."""
    scratch = scratch or Scratch(docs.sparkSession, "audit")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        # Equal texts are told by 128 bits.
        F.xxhash64(text).alias("a"),
        F.xxhash64(text, F.lit(7)).alias("b"),
        text.alias("text"),
    )
    counted = scratch.keep(TermMatrix(rows, scratch).row_counts(), "counted")
    # Written, so that the join has an exchange of its own on both sides and a hot text can be split.
    first = scratch.keep(counted.groupBy("a", "b").agg(F.min("doc").alias("first"), F.count("*").alias("n")), "texts")
    first = first.where("n > 1").drop("n")
    few = _bit(F.col("n_words") < LEAST_WORDS, "A")
    poor = _bit(100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"), "B")
    later = _bit(F.col("doc") > F.col("first"), "E")
    return counted.join(first, ["a", "b"], "left").select(
        "doc", "part", (F.col("flags") + few + poor + later).alias("failed"), "n_words", "n_distinct"
    )


def order_steps(spark: SparkSession) -> DataFrame:
    """(failed, filter_order, step, letter, gone, redundant, alone): what each step of each order does
    with documents of these failures. 32 x 120 x 5 rows, whatever the input."""
    rows = []
    for order in map("".join, permutations(FILTERS)):
        for failed in range(1 << len(FILTERS)):
            out = False
            for step, letter in enumerate(order, 1):
                fails = bool(failed >> FILTERS.index(letter) & 1)
                alone = failed == 1 << FILTERS.index(letter)
                rows.append((failed, order, step, letter, fails and not out, fails and out, alone, out or fails))
                out = out or fails
    names = "failed int, filter_order string, step int, letter string, gone boolean, redundant boolean, alone boolean, out boolean"
    return spark.createDataFrame(rows, names)


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    The filters: A fewer than 100 words; B distinct words below 80 % of words; C capitals A-Z above 10 % of code
    points; D one of ``#$%&*|``; E the text of a smaller id. ``labels`` has id, quality and toxic; a
    document without label, or with null values, is neither good nor toxic, and of several labels one that says so is enough.

    Each row of ``docs`` is a document. A null text is empty, a null part the empty one. A row without id is
    neither a copy of others nor does it make others copies, and has no label; rows of one id and text
    are no copies of each other. An empty table gives no rows. Other columns of ``docs`` are not read.

    Broadcast are the steps of all orders (fixed), the starts of the dictionary's partitions, and nothing else by rule.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "audit")
    failed = failures(docs, id_col, text_col, part_col, scratch)
    outcome = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("doc")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    judged = scratch.keep(failed.select("doc", "part", "failed"), "failed").join(scratch.keep(outcome, "outcome"), "doc", "left")
    # At most 32 x 9 rows for each part go on.
    cells = judged.groupBy("part", "failed", "good", "toxic").agg(F.count("*").alias("n"))
    cells = scratch.keep(cells, "cells")

    def count(*conditions: str) -> Column:
        held = F.lit(True)
        for c in conditions:
            held = held & F.coalesce(F.col(c), F.lit(False))
        return F.sum(F.when(held, F.col("n")).otherwise(0))

    steps = cells.join(F.broadcast(order_steps(spark)), "failed").groupBy("part", "filter_order", "step", "letter").agg(
        F.sum(F.when(~F.col("out"), F.col("n")).otherwise(0)).alias("kept"),
        count("gone").alias("removed"),
        count("redundant").alias("redundant"),
        count("alone").alias("unique_fails"),
        count("gone", "good").alias("good_lost"),
        count("gone", "toxic").alias("toxic_lost"),
    )
    return steps.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter"))).drop("letter")
