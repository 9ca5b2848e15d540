"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.llm.tables import Scratch

PART = 32.0
"""A larger mean is drawn as a sum of Poisson counts of at most this mean each."""
TERMS = 200
"""Terms of the distribution function; beyond them a mean of 32 has no weight that a double can hold."""
BITS = 52
BROADCAST_SOURCES = 10_000
"""Up to so many sources, their rates (1.6 KB each) are broadcast; beyond, joined by a shuffle."""


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts, joined by colons."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint") / F.lit(float(1 << BITS))


def square_root_weights(sizes: DataFrame) -> DataFrame:
    """Target weight of each source: the square root of its size."""
    return sizes.select("source", F.sqrt("size").alias("weight"))


def repetition_rates(sizes: DataFrame, weights: DataFrame) -> DataFrame:
    """(source, rate): what to repeat each source by, the total size kept.

    ``sizes`` has source and size, ``weights`` source and weight (any
    positive scale). A source without weight, or with a null one, has rate 0; a source without
    size has rate 1, since no rate changes its share.
    """
    w = weights.groupBy(F.col("source").alias("_s")).agg(F.sum("weight").alias("_w"))
    both = sizes.join(w, F.col("source").eqNullSafe(F.col("_s")), "left")
    both = both.select("source", F.col("size").cast("double").alias("_size"), F.coalesce("_w", F.lit(0.0)).alias("_w"))
    total = both.agg(F.sum("_size").alias("_all"), F.sum("_w").alias("_weights"))  # one row
    rate = F.col("_all") * F.col("_w") / F.col("_weights") / F.col("_size")
    return both.crossJoin(F.broadcast(total)).select(
        "source", F.when(F.col("_size") > 0, F.coalesce(rate, F.lit(0.0))).otherwise(1.0).alias("rate")
    )


def poisson_cdf(mean: Column) -> Column:
    """P(X <= j) for j = 0, 1, ... as an array."""
    start = F.struct(
        F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("all")
    )

    def more(acc: Column, j: Column) -> Column:
        p = acc["p"] * mean / j
        return F.struct(p.alias("p"), (acc["c"] + p).alias("c"), F.concat(acc["all"], F.array(acc["c"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, more, lambda acc: acc["all"])


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | None = None,
    seed: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Each document as often as its draw says, in random order, with ``copy`` and ``shuffle_key``.

    The size of a source is its code points. A document's count is Poisson with its source's rate, by
    inversion of a uniform number hashed from its id and the seed: the same on every
    run and under any partitioning. Copies are dealt to tasks by a hashed key and
    sorted by it, which is a random order over all rows; no source stays together.
    Without ``weights``, a source weighs the square root of its size. A null
    source is a source of its own. Rows of one id draw the same number; rows
    without id all draw that of the text "null". Null texts have size 0. Columns ``copy`` and
    ``shuffle_key`` of the input are replaced, others pass through.
    """
    docs = docs.drop("copy", "shuffle_key")
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.coalesce(F.sum(F.char_length(text_col)), F.lit(0)).alias("size")
    )
    rates = repetition_rates(sizes, square_root_weights(sizes) if weights is None else weights)
    rates = rates.withColumn("_parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int"))
    rates = rates.select(
        F.col("source").alias("_source"), "_parts", poisson_cdf(F.col("rate") / F.col("_parts")).alias("_cdf")
    )

    rates = Scratch(docs.sparkSession, "mixing").keep(rates, "rates")
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)

    def draw(part: Column) -> Column:
        u = uniform(F.col(id_col), F.lit(seed), part)
        return F.size(F.filter("_cdf", lambda c: c <= u))

    drawn = docs.join(rates, F.col(source_col).eqNullSafe(F.col("_source")))
    count = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.col("_parts")), draw), F.lit(0), lambda a, x: a + x
    )
    copies = (
        drawn.withColumn("_count", count)
        .where(F.col("_count") > 0)
        .drop("_source", "_parts", "_cdf")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_count"))))
        .drop("_count")
        .withColumn("shuffle_key", uniform(F.col(id_col), F.lit(seed), F.lit("order"), F.col("copy")))
    )
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
