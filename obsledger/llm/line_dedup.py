"""Line dedup: drop repeated lines, counted by the documents that hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.llm.tables import Scratch

STRIPPED = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.trim(line, F.lit(STRIPPED)), UPPER, UPPER.lower())


def key_hash(key: Column) -> Column:
    """128 bits: two hashes of the key that start from different seeds."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(key, F.lit(7)).alias("b"))


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    min_docs: int = 2,
) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, ``n_lines`` and ``n_dropped``.

    A line repeats if its key has ``min_chars`` code points or more and stands
    in ``min_docs`` documents or more. It stays in the smallest id that holds
    it, with all its occurrences there, and goes elsewhere; other lines stay in
    their order.

    Only ids, positions and hashes are shuffled to count, and written once; a key is combined per task
    first, so a line of a third of all documents is no hot group. The positions that a document loses
    are gathered, and its other lines joined by position, in time that grows with its lines. A null or
    empty text is one empty line, and the text that comes out is never null.
    Rows of one id are one document. A row without id is compared with
    nothing and keeps its lines. Further columns pass through; columns
    ``n_lines`` and ``n_dropped`` of the input are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n", -1)
    # A row's text is told by 128 bits: rows of one id may differ.
    row = [F.col(id_col).alias("_doc"), F.xxhash64(text).alias("_a"), F.xxhash64(text, F.lit(7)).alias("_b")]
    # Both sides of the joins below are read from written tables, so that each has an exchange
    # of its own and Spark can split the rows of a line that very many documents hold.
    scratch = Scratch(docs.sparkSession, "lines")
    placed = (
        docs.where(F.col(id_col).isNotNull())
        .select(*row, F.posexplode(lines).alias("_at", "_line"))
        .withColumn("_key", line_key(F.col("_line")))
        .where(F.char_length("_key") >= min_chars)
        .select("_doc", "_a", "_b", "_at", key_hash(F.col("_key")).alias("_hash"))
    )
    placed = scratch.keep(placed, "placed")
    repeated = (
        placed.select("_doc", "_hash").distinct()
        .groupBy("_hash")
        .agg(F.count("*").alias("_docs"), F.min("_doc").alias("_first"))
        .where(F.col("_docs") >= min_docs)
        .select("_hash", "_first")
    )
    repeated = scratch.keep(repeated, "repeated")
    drops = (
        placed.join(repeated, "_hash")
        .where(F.col("_doc") != F.col("_first"))
        .groupBy("_doc", "_a", "_b")
        .agg(F.collect_set("_at").alias("_drops"))
    )
    drops = scratch.keep(drops, "drops")
    keys = [c.alias(f"_own{k}") for k, c in enumerate(row)]
    joined = docs.drop("n_lines", "n_dropped").select("*", *keys).join(
        drops,
        (F.col("_own0") == F.col("_doc")) & (F.col("_own1") == F.col("_a")) & (F.col("_own2") == F.col("_b")),
        "left",
    )
    # A generator's output is computed once, also where it is read for every position.
    joined = joined.select("*", F.explode(F.array(lines)).alias("_lines"))
    places = F.sequence(F.lit(0), F.size("_lines") - 1)
    kept = F.transform(F.array_except(places, F.col("_drops")), lambda i: F.get("_lines", i))
    return (
        joined.withColumn(text_col, F.when(F.col("_drops").isNull(), text).otherwise(F.array_join(kept, "\n")))
        .withColumn("n_lines", F.size("_lines").cast("bigint"))
        .withColumn("n_dropped", F.coalesce(F.size("_drops"), F.lit(0)).cast("bigint"))
        .drop("_own0", "_own1", "_own2", "_doc", "_a", "_b", "_drops", "_lines")
    )
