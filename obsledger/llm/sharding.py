"""Sharding by a two-pass external shuffle.

Pass one scatters the records by a seeded hash into buckets that fit in memory; pass two shuffles each bucket
with Fisher and Yates's method and writes it. The buckets one after the other are all records in
random order, cut into shards whose numbers of rows differ by one at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from obsledger.llm.tables import Scratch

SHARDS = 24
BUCKET_BYTES = 64 << 20
LEAST_BUCKETS = 64
"""Small tables get so many buckets, so that there is work for more than one task."""
CHUNK = 1000
"""Copies of one record that a task makes at a time."""
BLOCK = 1024
"""Buckets whose rows are summed up in one task."""
ROW_BYTES = 8


def size_of(text: Column) -> Column:
    """Bytes of the text in UTF-8 (null: none) and 8 for the row."""
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("bigint") + ROW_BYTES


def _scattered(docs: DataFrame, scratch: Scratch, seed: int, bucket_bytes: int) -> tuple[DataFrame, int, int]:
    """``docs`` with ``_key`` and ``_order``, two hashes of the whole row; number and bytes of the rows.

    Equal rows have equal hashes. Where they are together too large for a bucket, they are combined into one row
    for each task, made into copies again, and a copy's number goes into its hashes: they
    scatter like other rows, and alike on every run. There are at most as many such records as buckets.
    """
    columns = docs.columns
    hashed = docs.withColumn("_key", F.xxhash64(F.lit(seed), *columns)).withColumn(
        "_order", F.xxhash64(F.lit(seed), F.lit("order"), *columns)
    )
    records = scratch.keep(
        hashed.groupBy("_key").agg(F.count("*").alias("_n"), F.sum("size").alias("_bytes")), "records"
    )
    total = records.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum("_bytes"), F.lit(0))).collect()[0]
    heavy = records.where((F.col("_bytes") > bucket_bytes) & (F.col("_n") > 1)).select("_key")
    if heavy.limit(1).count():
        heavy = F.broadcast(heavy)
        one = hashed.join(heavy, "_key", "left_semi").groupBy(*columns, "_key", "_order").agg(F.count("*").alias("_n"))
        chunks = one.withColumn("_first", F.explode(F.expr(f"sequence(0L, _n - 1, {CHUNK}L)")))
        copies = chunks.repartition("_key", "_first").withColumn(
            "_copy", F.explode(F.expr(f"sequence(_first, least(_first + {CHUNK}, _n) - 1)"))
        )
        copies = copies.withColumn("_key", F.xxhash64("_key", "_copy")).withColumn("_order", F.xxhash64("_order", "_copy"))
        hashed = hashed.join(heavy, "_key", "left_anti").unionByName(copies.drop("_n", "_first", "_copy"))
    return hashed, total[0], total[1]


def _bucket_starts(written: DataFrame) -> DataFrame:
    """(_bucket, _start): how many rows the buckets before hold. Summed in blocks of buckets, then over blocks."""
    counts = written.groupBy("_bucket").agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_block", F.floor(F.col("_bucket") / BLOCK))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = counts.groupBy("_block").agg(F.sum("_n").alias("_n"))
    blocks = blocks.select("_block", before(Window.orderBy("_block")).alias("_before"))
    inside = counts.withColumn("_inside", before(Window.partitionBy("_block").orderBy("_bucket")))
    return inside.join(blocks, "_block").select("_bucket", (F.col("_inside") + F.col("_before")).alias("_start"))


def shard_documents(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = 1,
    bucket_bytes: int = BUCKET_BYTES,
    least_buckets: int = LEAST_BUCKETS,
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with size, shard (from 0) and slot (from 0 in each shard), in random order.

    Shards differ by one row at most, the first ones are not smaller by rule. The order depends on the
    rows and the seed, not on how they are partitioned. A bucket has ``bucket_bytes`` on average, and what its
    longest text needs at least.

    A null text has the size of an empty one. Repeated rows and ids, and rows without id, are rows
    like others; a single record that is a large part of the table spreads over all buckets. Fewer
    rows than shards leave shards empty; an empty table gives no rows. Columns named as above are
    replaced, others pass through; they must be of types that Spark can hash (no maps).

    Every text is moved once and written once. Broadcast are the first position of each bucket (16 bytes for
    ``bucket_bytes`` of input) and the hashes of records too large for a bucket, fewer than buckets.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    sized = docs.drop("size", "shard", "slot").withColumn("size", size_of(F.col(text_col)))
    scattered, n, total = _scattered(sized, scratch, seed, bucket_bytes)
    buckets = max(least_buckets, -(-total // bucket_bytes))
    scattered = scattered.withColumn("_bucket", F.pmod("_key", F.lit(buckets))).drop("_key")
    fields = [f for f in scattered.schema.fields if f.name != "_order"]
    names = [f.name for f in fields]

    def shuffled(key: tuple[pa.Scalar], bucket: pa.Table) -> pa.Table:
        # From one order on, however the rows came; only equal rows have equal hashes.
        order = pc.sort_indices(bucket["_order"]).to_numpy().copy()
        np.random.Generator(np.random.PCG64([seed, key[0].as_py()])).shuffle(order)  # Fisher-Yates
        return bucket.select(names).take(order).append_column("_at", pa.array(np.arange(len(order))))

    schema = T.StructType([*fields, T.StructField("_at", T.LongType())])
    written = scratch.keep(scattered.groupBy("_bucket").applyInArrow(shuffled, schema), "buckets")
    starts = scratch.keep(_bucket_starts(written), "starts")
    return (
        written.join(F.broadcast(starts), "_bucket")
        .withColumn("_place", F.col("_start") + F.col("_at"))
        .withColumn("shard", F.expr(f"cast(_place * {shards} div {max(n, 1)} as int)"))
        .withColumn("slot", F.expr(f"_place - (cast(shard as bigint) * {n} + {shards - 1}) div {shards}"))
        .drop("_bucket", "_start", "_at", "_place")
    )


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One folder for each shard. A file holds rows of one task in the order of their slots."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
