"""Uniform sample of k rows, the same rows under any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.schema import SAMPLE_K, SAMPLE_SEED

# A pre-filter keeps about this many times k rows.
OVERSAMPLE = 16
_HASH_SPAN = float(2**64)


def row_hash(columns: list[str], seed: int = SAMPLE_SEED) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns], F.lit(seed))


def uniform_sample(
    df: DataFrame,
    k: int = SAMPLE_K,
    *,
    seed: int = SAMPLE_SEED,
    rank: Column | None = None,
    total_rows: int | None = None,
) -> DataFrame:
    """The k rows with the smallest seeded hash, in hash order (a shuffle too).

    Spark runs it as a top-k. On a table of many thousands of tasks each would
    still hand k rows to the last one; given ``total_rows``, a bound on the hash
    first thins them to a small multiple of k. The bound is only used once a
    count has shown that at least k rows pass it, so the sample is the same.
    """
    columns = df.columns
    ranked = df.withColumn("__rank", row_hash(columns, seed) if rank is None else rank)
    if rank is None and total_rows and total_rows > k * OVERSAMPLE:
        bound = int(-(2**63) + _HASH_SPAN * (k * OVERSAMPLE / total_rows))
        thinned = ranked.filter(F.col("__rank") <= bound)
        if thinned.limit(k).count() >= k:
            ranked = thinned
    return ranked.orderBy("__rank", *columns).limit(k).drop("__rank")


def merge_samples(
    old: DataFrame, new: DataFrame, *, k: int = SAMPLE_K, seed: int = SAMPLE_SEED
) -> DataFrame:
    """The sample of two tables together from a sample of each, both of k rows and this seed.

    A row among the k smallest of both tables is among the k smallest of its
    own, so nothing else is needed. Equal rows of both tables stay two rows.
    """
    return uniform_sample(old.unionByName(new), k, seed=seed)
