"""Needs-processing lists: files the next update has to read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.functions.text import strip
from obsledger.sources.manifest import is_path_missing

RUN_PREFIX = "needs_processing_"


def read_needs(spark: SparkSession, path: str) -> DataFrame:
    """Keys of one needs list, stripped, blanks dropped.

    A list without the ``s3_key`` column is an error, not an empty list.
    """
    df = spark.read.option("header", True).option("escape", '"').csv(path)
    if "s3_key" not in df.columns:
        raise ValueError(f"no column s3_key in the needs list {path}")
    return df.select(strip(F.col("s3_key")).alias("s3_key")).filter(
        F.length("s3_key") > 0
    )


def newest_needs(spark: SparkSession, folder: str) -> str | None:
    """Path of the list with the greatest name in ``folder``; None if there is none.

    A list is a file or a folder called ``needs_processing_<stamp>.csv``.
    """
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(f"{folder.rstrip('/')}/{RUN_PREFIX}*.csv")
            .select("path")
        )
    except AnalysisException as error:
        if not is_path_missing(error):
            raise
        return None
    name = F.regexp_extract("path", rf"^(.*/{RUN_PREFIX}[^/]*\.csv)(?:/[^/]*)?$", 1)
    return files.agg(F.max(name)).first()[0]


def named_files(manifest: DataFrame, keys: DataFrame, root: str) -> DataFrame:
    """The listed files that a needs list names, each once; names of files that are gone give nothing."""
    return manifest.join(resolve_keys(keys, root), "path", "left_semi")


def resolve_keys(keys: DataFrame, root: str) -> DataFrame:
    """Turn keys into paths: keys without scheme or leading slash lie below ``root``."""
    key = F.col("s3_key")
    absolute = key.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:|/)")
    return keys.select(
        F.when(absolute, key)
        .otherwise(F.concat(F.lit(root.rstrip("/") + "/"), key))
        .alias("path")
    )
