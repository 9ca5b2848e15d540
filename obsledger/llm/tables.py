"""Shared helpers: table reads, written intermediate tables, Arrow columns, components."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsledger.session import new_run_id, work_dir

SLICE_BYTES = 8 << 20
"""Arrow batches are worked on in slices of about this size, so that a task's
Python memory depends on its longest row and not on the rows of a batch."""

Columns = Callable[[pa.RecordBatch], list]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Written tables of one run, in the shared folder of the cluster.

    A table written and read back cuts the lineage: a lost executor costs the
    tasks it ran, never the steps before.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{work_dir(spark)}/{label}-{new_run_id()}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        # Shuffle files of finished steps go once the driver has collected
        # what refers to them; long chains of steps would fill the disks.
        gc.collect()
        self.spark._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Remove a table of this run that no later step reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        step = max(1, int(batch.num_rows * SLICE_BYTES / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def map_rows(df: DataFrame, schema: T.StructType, make: Callable[[], Columns]) -> DataFrame:
    """One output row for each input row; ``make`` runs once per task and gives the function."""
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = make()
        for piece in slices(batches):
            yield pa.RecordBatch.from_arrays(columns(piece), names=names)

    return df.mapInArrow(run, schema)


def add_columns(df: DataFrame, added: T.StructType, make: Callable[[], Columns]) -> DataFrame:
    """All columns of ``df`` and the computed ones; a column of the same name is replaced."""
    new = added.fieldNames()
    kept = [f for f in df.schema.fields if f.name not in new]
    names = [f.name for f in kept] + new

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = make()
        for piece in slices(batches):
            old = [piece.column(piece.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*old, *columns(piece)], names=names)

    return df.mapInArrow(run, T.StructType([*kept, *added.fields]))


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    return ["" if t is None else t for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges (a, b)`` is connected with.

    Each round takes the smallest label among the neighbours and then the label
    of that label, so a path of n edges takes about log n rounds. Sums are
    combined before the shuffle and joins split hot keys, so a node with very
    many neighbours does not land in one task. Nulls and self loops add nothing.
    """
    both = edges.select("a", "b").where("a <> b")
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = scratch.keep(both, f"{label}-edges")
    labels = scratch.keep(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component")),
        f"{label}-0",
    )
    step = 0
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "a"), "a")
            .select(F.col("b").alias("node"), "component")
            .groupBy("node")
            .agg(F.min("component").alias("_near"))
        )
        closer = labels.join(near, "node").select(
            "node", F.col("component").alias("_old"), F.least("component", "_near").alias("_mid")
        )
        # A label is itself a node: go on to its label.
        onward = labels.select(F.col("node").alias("_mid"), F.col("component").alias("_far"))
        moved = closer.join(onward, "_mid").select(
            "node", F.least("_mid", "_far").alias("component"), "_old"
        )
        step += 1
        written = scratch.keep(moved, f"{label}-{step}")
        changed = written.where(F.col("component") != F.col("_old")).limit(1).count()
        scratch.drop(f"{label}-{step - 1}")
        labels = written.drop("_old")
        if not changed:
            return labels
